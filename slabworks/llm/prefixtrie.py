"""The trie of conversation prefixes, by adaptive radix trees over turn ids.

A turn's id has WIDTH bytes, the head of a SHA-256 of its role and text, and a conversation's key is its turns' ids in
a row.  Keys are sorted over the cluster and cut into slabs of bounded size; each slab is one adaptive radix tree,
and only places at a multiple of WIDTH bytes are nodes of the trie: a path of many turns that nothing leaves gives
one node a turn, and a branch inside an id's bytes none.

Slabs are neighbours in sorted order, so only nodes on the way to a slab's first or last key can have members in
other slabs.  All others are finished within their slab.  Those on the way are partial rows, merged by the hash of
their prefix; a node that only one slab has is finished too.  For the few that slabs share, sums over subtrees go up
by pointer doubling: in each round a node adds what the nodes 2^k below it have, so a trie of depth d takes log d
rounds.  Keys are cut by (key, conv_id): a conversation that a third of all rows repeat lies in many slabs.

Ids of two different turns are equal with a chance of 2^-128 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slabworks.llm.common import arrow_map, table, written
from slabworks.llm.radix import Tree

WIDTH = 16
#: Conversations and bytes of keys of a slab at most; one longer conversation is a slab of its own.
SLAB_ROWS = 8_192
SLAB_BYTES = 16 << 20

_TEXTS, _BYTES = ("ends_sha256", "ends"), ("node", "parent")
_FIELDS = "node parent depth conv_id parent_conv_id bytes n_convs n_children n_leaves saved rest_children rest_leaves rest_saved ends_sha256 first_end ends".split()
_SCHEMA = pa.schema([(x, pa.string() if x in _TEXTS else pa.binary() if x in _BYTES else pa.int64()) for x in _FIELDS])
_ROWS = ", ".join(f"{x} {'string' if x in _TEXTS else 'binary' if x in _BYTES else 'long'}" for x in _FIELDS)


def _prefix_hashes(key: bytes) -> list[bytes]:
    """The name of each prefix of whole turns."""
    h, out = hashlib.sha256(), []
    for at in range(0, len(key) + 1, WIDTH):
        h.update(key[max(0, at - WIDTH) : at])
        out.append(h.digest()[:16])
    return out


def slab_nodes(convs: list[int], keys: list[bytes], sizes: list[list[int]]) -> Iterator[tuple]:
    """Rows of the trie nodes of conversations sorted by key and id, finished or (with a name) on the way to the first or last."""
    tree = Tree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    last = len(keys) - 1
    depth, size, n, least, kids, leaves, saved, edge, parent, ends = ([] for _ in range(10))
    rest: list[tuple[int, int, int]] = []
    below: dict[int, list] = {}  # of a node of the tree: its topmost trie nodes, members, least id, first and last member
    for node, start, end in tree.post_order():
        tops, members, smallest, lo, hi = [], len(node.ends), min((convs[i] for i in node.ends), default=None), last + 1, -1
        if node.ends:
            lo, hi = node.ends[0], node.ends[-1]
        for _, child in node.items():
            t, m, s, a, b = below.pop(id(child))
            tops += t
            members, smallest, lo, hi = members + m, s if smallest is None else min(s, smallest), min(lo, a), max(hi, b)
        top = start - start % WIDTH + WIDTH if node is not tree.root else 0
        for at in range(end - end % WIDTH, top - 1, -WIDTH):
            d, own = at // WIDTH, len(depth)
            size.append(sizes[lo][d - 1] if d else 0)
            depth.append(d)
            n.append(members)
            least.append(smallest)
            kids.append(len(tops))
            edge.append(lo == 0 or hi == last)
            parent.append(-1)
            ends.append(([convs[i] for i in node.ends] if at == end else [], lo))
            inner = [t for t in tops if not edge[t]]
            rest.append((len(inner), sum(leaves[t] for t in inner), sum(saved[t] for t in inner)))
            leaves.append(sum(leaves[t] for t in tops) if tops else 1)
            saved.append(sum(saved[t] for t in tops) + (members - 1) * size[own])
            for t in tops:
                parent[t] = own
            tops = [own]
        below[id(node)] = [tops, members, smallest, lo, hi]
    names = {0: _prefix_hashes(keys[0]), last: _prefix_hashes(keys[last])}

    def name(i: int) -> bytes | None:
        return names[0 if ends[i][1] == 0 else last][depth[i]] if edge[i] else None

    for i in range(len(depth)):
        said, up = ",".join(map(str, ends[i][0])), parent[i]
        sha = hashlib.sha256(said.encode()).hexdigest()
        if edge[i]:
            above = names[0 if ends[i][1] == 0 else last][depth[i] - 1] if depth[i] else None
            yield name(i), above, depth[i], least[i], None, size[i], n[i], kids[i], leaves[i], saved[i], *rest[i], sha, ends[i][0][0] if said else None, said or None
        else:
            yield None, name(up), depth[i], least[i], None if edge[up] else least[up], size[i], n[i], kids[i], leaves[i], saved[i], None, None, None, sha, None, None


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node rows of a task's sorted conversations, slab by slab."""
    convs, keys, sizes, held = [], [], [], 0

    def rows() -> pa.RecordBatch:
        columns = zip(*slab_nodes(convs, keys, sizes))
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    for batch in batches:
        for c, k, s in zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist(), batch.column("sizes").to_pylist()):
            if convs and (len(convs) >= SLAB_ROWS or held + len(k) > SLAB_BYTES):
                yield rows()
                convs, keys, sizes, held = [], [], [], 0
            convs.append(c)
            keys.append(k)
            sizes.append(s)
            held += len(k)
    if convs:
        yield rows()


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node of its pieces in order; only the running digest is held."""
    node, running = None, None
    for batch in batches:
        done = []
        for own, piece in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if own != node:
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = own, hashlib.sha256()
            else:
                running.update(b",")
            running.update(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def turn_keys(rows: DataFrame) -> DataFrame:
    """conv_id, ids (hexadecimal turn ids in order) and sizes (UTF-8 bytes of the texts) of each conversation.

    Turns are ordered by turn, null first, then role and text.  A null role or text is an empty one, repeated rows
    are repeated turns, and rows without a conv_id are in no conversation.  A conversation is one record.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    turns = turns.select("conv_id", place.alias("place"), F.substring(F.sha2(said, 256), 1, 2 * WIDTH).alias("id"), F.octet_length("text").cast("long").alias("size"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "id", "size"))).alias("t"))
    return whole.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def prefix_trie(convs: DataFrame) -> DataFrame:
    """The trie of conversations given as conv_id, ids (hexadecimal turn ids) and sizes (bytes of each turn's text).

    One row a node: conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, (n_convs - 1) times the bytes of a node's last text) and ends_sha256
    (of the ids of members that end there, ascending and comma-joined).  A conversation without turns ends at the
    root; repeated rows are members of their own.  Rows without a conv_id take no part; without conversations there
    is no node, not even a root.  Other columns are not looked at.
    """
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = convs.where("conv_id is not null").select("conv_id", F.unhex(F.array_join("ids", "")).alias("key"), "sizes")
    keyed = keyed.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = written(arrow_map(keyed, _slabs, _ROWS), "trie-rows")

    on_way = rows.where("node is not null")
    total = {"n_convs": F.sum, "conv_id": F.min, "depth": F.first, "bytes": F.first, "parent": F.first, "rest_children": F.sum, "rest_leaves": F.sum, "rest_saved": F.sum, "n_children": F.first, "n_leaves": F.first, "saved": F.first, "ends_sha256": F.first}
    merged = written(on_way.groupBy("node").agg(F.count("*").alias("parts"), *[f(c).alias(c) for c, f in total.items()]), "trie-merged")

    # what each child on the way adds to a shared parent; a child that one slab has is finished
    alone = F.col("parts") == 1
    gives = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("more"), F.sum(F.when(alone, F.col("n_leaves")).otherwise(0)).alias("more_leaves"), F.sum(F.when(alone, F.col("saved")).otherwise(0)).alias("more_saved")
    )
    shared = merged.where("parts > 1").join(gives, "node", "left")
    children = F.col("rest_children") + F.coalesce("more", F.lit(0))
    leaves = F.when(children == 0, 1).otherwise(F.col("rest_leaves") + F.coalesce("more_leaves", F.lit(0)))
    saved = F.col("rest_saved") + F.coalesce("more_saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("bytes")
    shared = written(shared.select("node", "parent", "depth", "conv_id", "n_convs", children.alias("n_children"), leaves.alias("n_leaves"), saved.alias("saved")), "trie-shared")
    sums = shared.select("node", F.col("parent").alias("above"), "n_leaves", "saved")
    while sums.where("above is not null").limit(1).count():
        added = sums.where("above is not null").groupBy(F.col("above").alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        higher = sums.select(F.col("node").alias("above"), F.col("above").alias("next"))
        sums = sums.join(added, "node", "left").join(higher, "above", "left")
        sums = written(sums.select("node", F.col("next").alias("above"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "trie-sums")

    pieces = on_way.where("ends is not null").join(shared.select("node"), "node", "left_semi").select("node", "first_end", "ends")
    pieces = pieces.repartition(parts, "node").sortWithinPartitions("node", "first_end")
    hashes = arrow_map(pieces.select("node", "ends"), _end_hashes, "node binary, ends_sha256 string")
    shared = shared.drop("n_leaves", "saved").join(sums.select("node", "n_leaves", "saved"), "node").join(hashes, "node", "left")
    shared = shared.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))

    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"]
    inner = ["parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    below = rows.where("node is null and parent is not null").select(inner).unionByName(merged.where(alone).select(inner)).unionByName(shared.select(inner))
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return rows.where("node is null and parent is null").select(out).unionByName(below.join(above, "parent", "left").select(out))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Each conversation c begun by the first h turns of conversation c - c % 5, where h = crc32(c) % 9; see ``turn_keys``."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    base = convs.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("ids", 1, 8).alias("base_ids"), F.slice("sizes", 1, 8).alias("base_sizes"))
    both = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(base, "base", "left")

    def joined(column: str, kind: str):
        head = F.slice(F.coalesce(f"base_{column}", F.expr("array()").cast(f"array<{kind}>")), F.lit(1), h)
        return F.concat(head, F.slice(column, h + 1, F.greatest(F.size(column) - h, F.lit(0))))

    return both.select("conv_id", joined("ids", "string").alias("ids"), joined("sizes", "long").alias("sizes"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(written(turn_keys(table(spark, sf_dir, "conversations")), "trie-turns")))


#: DuckDB has no crc32: the table-driven CRC is spelled out over the decimal's bytes.
_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda r, x: {steps})"


def _crc_sql() -> str:
    step = "xor(r, x)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda v: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)[1]"
    return f"xor({_CRC.format(steps=step)}, 4294967295::BIGINT)"


OP13_SQL = f"""
WITH RECURSIVE turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, octet_length(encode(coalesce(text, ''))) AS size
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT c, {_crc_sql()} % 9 AS h FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
    SELECT convs.c, i, id, size FROM convs JOIN turns ON turns.c = convs.c - convs.c % 5 AND i <= h
    UNION ALL
    SELECT convs.c, (SELECT least(h, count(*)) FROM turns t WHERE t.c = convs.c - convs.c % 5) + i - h, id, size FROM convs JOIN turns ON turns.c = convs.c AND i > h
), paths(c, d, node, parent, size) AS (
    SELECT c, 0::BIGINT, '', NULL::VARCHAR, 0::BIGINT FROM convs
    UNION ALL
    SELECT p.c, p.d + 1, sha256(p.node || r.id), p.node, r.size::BIGINT FROM paths p JOIN rebuilt r ON r.c = p.c AND r.i = p.d + 1
), ends AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
nodes AS (
    SELECT node, p.d AS depth, any_value(parent) AS parent, min(p.c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
           sha256(coalesce(string_agg(CASE WHEN p.d = ends.d THEN p.c::VARCHAR END, ',' ORDER BY p.c), '')) AS ends_sha256
    FROM paths p JOIN ends USING (c) GROUP BY node, p.d
), kids AS (SELECT parent, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids ON kids.parent = nodes.node),
reach(node, below) AS (
    SELECT node, node FROM nodes
    UNION ALL
    SELECT nodes.parent, reach.below FROM reach JOIN nodes USING (node) WHERE nodes.parent IS NOT NULL
), sums AS (
    SELECT r.node, CAST(sum(CASE WHEN f.k = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((f.n_convs - 1) * f.size) AS BIGINT) AS saved_tokens
    FROM reach r JOIN full_nodes f ON f.node = r.below GROUP BY r.node
)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.k AS n_children, n_leaves, saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums USING (node) LEFT JOIN nodes up ON up.node = f.parent
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op13_prefix_trie": op13_prefix_trie}
ORACLE: dict[str, str] = {"op13_prefix_trie": OP13_SQL}
