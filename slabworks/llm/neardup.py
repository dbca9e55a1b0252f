"""Near-duplicates by bottom-k sketches.

One hash function is applied to all word shingles of a text; the K smallest values of the set are its sketch.
Texts with equal sets are one node.  Inverted lists of the retained values propose pairs, the sketch of the union
estimates their Jaccard similarity and drops the hopeless ones, and the full sets decide.

What keeps hot lists linear:

* A linked pair shares at least LEAST_SHARED of K retained values, so each node looks only at its rarest
  K - LEAST_SHARED + 1 values (the prefix of the list of values by corpus frequency); values of a very common line
  or passage are seldom among them.
* Each list proposes its members to one hub, the member whose retained values are the most common in the corpus.  Verified links are
  contracted to components, and only lists that still hold several components go on.
* Of those, short lists propose all pairs between components.  Long ones would propose too many, so their members
  are proposed by the rarest shingles of their full sets, again between components only.
* Every proposed pair passes the union sketch's estimate before its full sets are compared.

A linked pair at exactly the limit shares fewer than LEAST_SHARED of K retained values with a chance of about 3e-13
(binomial with 48 draws at 0.8), and is then missed.  Words are hashed modulo a prime, shingles are 63-bit values
made of their words' hashes: full sets are compared as sets of those, so a verdict can be wrong only for a pair
within a shingle or two of the limit, and only if two of its some thousand values collide by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.llm import textkit as K
from slabworks.llm.common import arrow_map, packed, table, written
from slabworks.llm.components import connected_components

#: Values in a sketch, and how many of them a pair at the limit shares at least (see above).
SKETCH = 48
LEAST_SHARED = 16
#: Members up to which a list proposes all pairs between its components.
SHORT_LIST = 24
#: Bits of a full set's parity signature.
BITS = 1024


def shingle_sets(col: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 63-bit shingle hashes) of every text; empty for a text without words."""
    for lo, hi, data, at in K.slices(col):
        low = K.LOWER[data]
        starts, ends, doc = K.words(low, at)
        w = K.Spans(low).of(starts, ends)
        every = K.window_hash(w, words) >> K.U64(1)
        first = np.searchsorted(doc, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= words:
                yield lo + i, np.unique(every[a : b - words + 1])
            elif b > a:
                yield lo + i, (K.window_hash(w[a:b], b - a) ^ K.mix(np.full(1, b - a, K.U64))) >> K.U64(1)
            else:
                yield lo + i, np.zeros(0, K.U64)


def set_id(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, look (hash of the text), n (set size), sid (128-bit name of the set, null if empty) and sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sids, out = [], [], []
            for _, s in shingle_sets(batch.column("text"), words):
                n.append(len(s))
                sids.append(set_id(s))
                out.append(s[:SKETCH].astype(np.int64))
            flat = np.concatenate(out) if out else np.zeros(0, np.int64)
            ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
            sketch = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("look"), pa.array(n, pa.int64()), pa.array(sids, pa.binary()), sketch], names=["doc_id", "look", "n", "sid", "sketch"])

    return arrow_map(docs.select("doc_id", F.xxhash64("text").alias("look"), F.col("text").cast("string").alias("text")), run, f"doc_id {kind}, look long, n long, sid binary, sketch array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(sid, shingles, bits) of the nodes whose representative rows (look, doc_id) are wanted, written once.

    bits has for each of BITS classes of hashes whether the set has an odd number of them: two sets differ in at
    least as many shingles as their bits differ in places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, sets, bits = [], [], []
            for _, s in shingle_sets(batch.column("text"), words):
                sids.append(set_id(s))
                sets.append(s.astype(np.int64))
                odd = np.bincount((s % K.U64(BITS)).astype(np.int64), minlength=BITS) & 1
                bits.append(np.packbits(odd.astype(bool)).view(np.int64))
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            words64 = np.concatenate(bits) if bits else np.zeros(0, np.int64)
            at = np.arange(len(sids) + 1, dtype=np.int32) * (BITS // 64)
            columns = [pa.array(sids, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.ListArray.from_arrays(pa.array(at), pa.array(words64))]
            yield pa.RecordBatch.from_arrays(columns, names=["sid", "shingles", "bits"])

    texts = docs.select(F.col("doc_id"), F.xxhash64("text").alias("look"), F.col("text").cast("string").alias("text"))
    keys = wanted.select(F.col("look").alias("_look"), F.col("rep_id").alias("_rep"))
    one = texts.join(keys, (F.col("look") == F.col("_look")) & F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
    one = one.dropDuplicates(["look", "doc_id"])  # repeated rows
    return written(arrow_map(one.select("text"), run, "sid binary, shingles array<long>, bits array<long>"), "near-sets")


def _least_size(n: Column, percent: int) -> Column:
    """The least overlap of a set of n with one at most as large: percent of n, rounded up."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)


def prefix_keys(reps: DataFrame, percent: int) -> DataFrame:
    """(v, sid, n, weight): the rarest retained values by which each node is looked up.

    weight sums how often all its retained values occur: it is greatest at the centre of a group of near copies.
    """
    values = reps.select("sid", "n", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    rows = values.join(shared, "v").groupBy("sid").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("c", "v"))).alias("vs"))
    size = F.least(F.col("n"), F.lit(SKETCH)).cast("int")
    own = size - F.size("vs")
    least = F.least(F.lit(LEAST_SHARED), _least_size(F.col("n"), percent))
    keep = F.greatest(size - least + 1 - own, F.lit(0))
    weight = F.aggregate("vs", F.lit(0).cast("long"), lambda acc, x: acc + x.c)
    return rows.select("sid", "n", weight.alias("weight"), F.explode(F.slice("vs", F.lit(1), keep)).alias("x")).select("x.v", "sid", "n", "weight")


def estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the sketch of the union doesn't rule out."""
    s = reps.select("sid", "n", "sketch")
    both = pairs.join(s.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a").join(s.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), F.lit(1), F.lit(SKETCH))
    shared = F.size(F.array_intersect(F.array_intersect(union, "sa"), "sb"))
    exact = (F.col("na") <= SKETCH) & (F.col("nb") <= SKETCH)
    inter = F.size(F.array_intersect("sa", "sb"))
    whole = inter * 100 >= (F.col("na") + F.col("nb") - inter) * percent
    return both.where(F.when(exact, whole).otherwise(shared >= LEAST_SHARED)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets' Jaccard similarity reaches the limit."""
    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y")), "b")
    inter = F.size(F.array_intersect("x", "y"))
    return both.where(inter * 100 >= (F.size("x") + F.size("y") - inter) * percent).select("a", "b")


def _reps_of(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    nodes = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    return reps.join(nodes, "sid", "left_semi")


def exact_prefix_pairs(sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that can reach the limit, by prefixes of full sets, rarest shingles first.

    A pair with |x| <= |y| at the limit shares a shingle among the first |x| - ceil(2p / (100 + p) |x|) + 1 of x and
    the first |y| - ceil(p / 100 |y|) + 1 of y.
    """
    rows = sets.join(comps, "sid").select("sid", "comp", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    shared = rows.groupBy("s").agg(F.count("*").alias("c"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c > 1")
    ranked = rows.join(shared, "s").groupBy("sid").agg(F.first("comp").alias("comp"), F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("c", "s", (F.col("c0") != F.col("c1")).alias("open")))).alias("ss"))
    own = F.col("n") - F.size("ss")
    probe = F.greatest(F.col("n") - _least_size(F.col("n"), percent) + 1 - own, F.lit(0))
    index = F.col("n") - F.floor((2 * percent * F.col("n") + 99 + percent) / (100 + percent)).cast("int") + 1
    keys = ranked.select("sid", "comp", "n", own.alias("own"), index.alias("index"), F.posexplode(F.slice("ss", F.lit(1), probe)).alias("pos", "x")).where("x.open")
    keys = keys.join(sets.select("sid", "bits"), "sid")
    keys = written(keys.select("sid", "comp", "n", "bits", (F.col("own") + F.col("pos")).alias("place"), "index", "x.s"), "near-prefix")
    name = lambda tag: [F.col(c).alias(f"{c}_{tag}") for c in ("sid", "comp", "n", "bits", "place")]
    small, large = keys.where("place < index").select(*name("a"), "s"), keys.select(*name("b"), "s")
    na, nb = F.col("n_a"), F.col("n_b")
    fits = (F.col("comp_a") != F.col("comp_b")) & ((na < nb) | ((na == nb) & (F.col("sid_a") != F.col("sid_b")))) & _similar_sizes(na, nb, percent)
    # from the first shared shingle on, no more can be shared than either has left
    left = F.least(na - F.col("place_a"), nb - F.col("place_b"))
    fits = fits & (left * (100 + percent) >= (na + nb) * percent)
    differ = sum((F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
    fits = fits & (differ * (100 + percent) <= (na + nb) * (100 - percent))
    return small.join(large, "s").where(fits).select(F.least("sid_a", "sid_b").alias("a"), F.greatest("sid_a", "sid_b").alias("b")).distinct()


def nodes_named(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(sid, doc_id, look, n, comp, component_id) of each row: its node, component and the component's smallest doc_id."""
    docs = docs.select("doc_id", "text")
    rows = written(sketches(docs, words), "near-rows")
    reps = rows.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("look", "doc_id")).alias("rep"))
    reps = written(reps.select("sid", "first_id", "n", "sketch", "rep.look", F.col("rep.doc_id").alias("rep_id")), "near-nodes")
    keys = written(prefix_keys(reps, percent), "near-keys")
    lists = keys.groupBy("v").agg(F.count("*").alias("m"), F.max(F.struct("weight", "sid", "n")).alias("hub")).where("m > 1")
    lists = written(lists.select("v", "m", F.col("hub.sid").alias("hub"), F.col("hub.n").alias("hub_n")), "near-lists")

    members = keys.join(lists, "v")
    to_hub = members.where((F.col("sid") != F.col("hub")) & _similar_sizes(F.col("n"), F.col("hub_n"), percent))
    pairs = to_hub.select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).distinct()
    pairs = written(estimated(pairs, reps, percent), "near-pairs")
    links = written(verified(pairs, full_sets(docs, _reps_of(pairs, reps), words), percent), "near-links")
    first = written(connected_components(links), "near-components")

    labels = first.select(F.col("node").alias("sid"), "label")
    comp = F.coalesce(F.col("label"), F.col("sid"))
    placed = members.where("m > 2").select("v", "m", "hub", "sid", "n").join(labels, "sid", "left").withColumn("comp", comp).drop("label")
    placed = written(placed, "near-placed")
    open_ = placed.groupBy("v").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("v")
    still = placed.join(open_, "v", "left_semi")
    short = still.where((F.col("m") <= SHORT_LIST) & (F.col("sid") != F.col("hub"))).select("v", "sid", "n", "comp")
    left = short.select("v", F.col("sid").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"))
    right = short.select("v", F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"))
    more = left.join(right, "v").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _similar_sizes(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct()
    more = written(estimated(more, reps, percent), "near-pairs")
    long_ = written(still.where(F.col("m") > SHORT_LIST).select("sid", "comp").distinct(), "near-long")
    wanted = _reps_of(more, reps).select("sid", "look", "rep_id").union(reps.join(long_, "sid", "left_semi").select("sid", "look", "rep_id")).distinct()
    sets = full_sets(docs, wanted, words)
    rest = written(estimated(exact_prefix_pairs(sets, long_, percent), reps, percent), "near-pairs")
    more_links = verified(more.union(rest).distinct(), sets, percent)

    names = more_links.join(labels.select(F.col("sid").alias("a"), F.col("label").alias("la")), "a", "left").join(labels.select(F.col("sid").alias("b"), F.col("label").alias("lb")), "b", "left")
    second = connected_components(names.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    roots = reps.select("sid", "first_id").join(labels, "sid", "left").select("sid", "first_id", comp.alias("comp"))
    roots = roots.join(second.select(F.col("node").alias("comp"), F.col("label").alias("label2")), "comp", "left").select("sid", "first_id", F.coalesce("label2", "comp").alias("comp"))
    roots = written(roots, "near-roots")
    least = roots.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = roots.join(least, "comp").select("sid", "comp", "component_id")
    return rows.select("doc_id", "look", "n", "sid").join(named, "sid", "left")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id and kept.

    A document's set is its distinct shingles of ``words`` words (runs without ASCII white space, A-Z in lower
    case), or its whole sequence as one if it has fewer; two documents are linked if their sets' intersection is at
    least ``percent`` hundredths of their union.  component_id is the smallest doc_id that links lead to; kept is
    true for that document.  A null text or one without words has an empty set and is linked with nothing.  A null
    doc_id takes part but is never the smallest; alone it has a null component_id and is kept.  Repeated rows are in
    one component and, if they are the smallest, all kept.  Other columns are not looked at.
    """
    out = nodes_named(docs, words, percent)
    found = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), found.alias("component_id"), F.coalesce(F.col("doc_id") == found, found.isNull()).alias("kept"))


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, then text hash; nulls come last.

    Rows without words are linked with nothing and all stay, null texts included.
    """
    nodes = nodes_named(docs, words, percent).where("sid is not null")
    best = nodes.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "look")).alias("best"))
    stay = best.select(F.col("best.doc_id").alias("best_id"), F.col("best.look").alias("best_look"))
    rows = packed(docs, own=F.xxhash64("text"), id=F.col("doc_id"), worded=F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    kept = rows.where("worded").join(stay, (F.col("own") == F.col("best_look")) & F.col("id").eqNullSafe(F.col("best_id")), "left_semi")
    return kept.dropDuplicates(["own", "id"]).select("row.*").unionByName(rows.where("not worded").select("row.*"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)


OP8_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
comp AS (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(least, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(least, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.doc_id = w.doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op8_near_duplicates": op8_near_duplicates}
ORACLE: dict[str, str] = {"op8_near_duplicates": OP8_SQL}
