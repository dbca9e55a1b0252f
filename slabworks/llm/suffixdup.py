"""Removal of byte strings that occur anywhere else, through merged Burrows-Wheeler transforms.

Every string of LENGTH bytes has an anchor: the least hash of its ANCHOR-byte substrings.  Strings in a row with one
anchor are a segment.  Equal strings have equal anchors, so an anchor that one segment has alone (and once) can't
repeat, and segments of different anchors needn't meet: a segment is the unit that is sent, an anchor the key it is
sent by, and no string is lost.  Segments that are left are collapsed where equal, with the number of their copies as
a weight; those of one anchor are cut to what they can have in common and become rows of one transform: shards are
built from a bounded number of bytes and merged by refining their interleave, and blocks of suffixes with a common
prefix of LENGTH and a total weight of two are the repeated strings, of all copies of a segment.
Anchors with more than HOT different segments are not held by one task: their strings are compared by two 61-bit
hashes of pieces and strings instead, all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.llm import textkit as K
from slabworks.llm.bwt import repeated_starts
from slabworks.llm.common import arrow_map, bucketed, dropped, table, text_key, written
from slabworks.session import ship

LENGTH = 400
ANCHOR = 128
#: Strings in a segment at most: as many as hold an anchor at one place, so that only runs of an anchor that stands at
#: several places are cut.  A shorter bound would give one text's anchor two segments, which look like a repeat.
LONGEST = LENGTH - ANCHOR + 1
#: Different segments of an anchor beyond which its strings are counted by hash.
HOT = 200
#: Bytes in a shard, and bytes of segments that are merged at once, about.
SHARD, BLOCK = 1 << 18, 1 << 18
#: Distances from the anchor whose strings are told apart before segments are compared.
COARSE = 68
#: Bytes of text whose anchors are sought at once, about: arrays of its hashes stay in a core's cache.
SLICE = 1 << 16
#: Strings in a piece of a hot anchor's segment.
PIECE = 8


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Least value of every w in a row."""
    out, have = h, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """doc, start, strings, anchor and where the anchor stands from start (-1 if at several places) of texts' segments."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    if len(data) < LENGTH:
        return none
    h = anchor_hashes(data)
    w = LENGTH - ANCHOR + 1
    least = _sliding_min(h, w)  # of the string that begins at each place
    inside = np.zeros(len(least), dtype=bool)
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= LENGTH:
            inside[a : b - LENGTH + 1] = True
    places = np.flatnonzero(inside)
    if not len(places):
        return none
    values = least[places]
    new = np.ones(len(places), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (places[1:] != places[:-1] + 1)
    doc = K.document_of(places, at)
    new[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(places))
    parts = -(-count // LONGEST)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, count = np.repeat(first, parts) + nth * LONGEST, np.repeat(count, parts) - nth * LONGEST
        count = np.minimum(count, LONGEST)
    anchor, start = values[first], places[first]
    # the first and second place of each segment's anchor, among the few places with hashes that low
    low = np.flatnonzero(h <= anchor.max())
    order = np.argsort(h[low], kind="stable")
    low = low[order]
    kinds = h[low]
    rank = np.cumsum(np.diff(kinds, prepend=kinds[:1]) != 0)
    keys = rank * (len(h) + 1) + low
    own = rank[np.searchsorted(kinds, anchor)]
    i = np.searchsorted(keys, own * (len(h) + 1) + start)
    again = np.minimum(i + 1, len(keys) - 1)
    several = (again > i) & (rank[again] == own) & (low[again] < start + count - 1 + w)
    return doc[first], start - at[doc[first]], count, anchor, np.where(several, -1, low[i] - start)


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each place."""
    return K.rolling(data, ANCHOR)


def find_segments(docs: DataFrame) -> DataFrame:
    """(key, anchor, place) of all texts of docs(key, text); place packs start, strings and the anchor's place + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in K.slices(batch.column("text"), SLICE):
                doc, start, n, anchor, where = segments(data, at)
                place = start << 20 | n << 10 | where + 1
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(lo, hi - lo).take(pa.array(doc)), pa.array(anchor.view(np.int64)), pa.array(place)], names=["key", "anchor", "place"])

    return arrow_map(docs.select("key", "text"), run, "key binary, anchor long, place long")


def _placed(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, pa.Array, pa.StructArray, np.ndarray, np.ndarray]:
    """Bytes of a batch's texts, and for the segments in a list column: their rows, fields, first bytes and sizes."""
    raw, at = K.utf8(batch.column("text"))
    segs = batch.column(column)
    of = np.repeat(np.arange(len(batch)), segs.value_lengths().to_numpy(zero_copy_only=False))
    fields = segs.flatten()
    place = fields.field("place").to_numpy()
    return raw, pa.array(of), fields, at[of] + (place >> 20), (place >> 10 & 1023) + LENGTH - 1


def name_segments(texts: DataFrame) -> DataFrame:
    """(key, anchor, place, copies, name, cores) from texts(key, text, copies, segs).

    name is a 128-bit hash of the segment.  A string begins up to LENGTH - ANCHOR bytes before its anchor; those that
    begin within one COARSE distances share a core, and cores has the hash of each core that the segment holds, with
    its distance: equal strings of different segments have a core in common.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, of, fields, first, size = _placed(batch, "segs")
            where = (fields.field("place").to_numpy() & 1023) - 1
            step = np.arange((LENGTH - ANCHOR) // COARSE + 1)
            begin = where[:, None] - COARSE * step  # of the core, from the segment's first byte
            # the strings of a distance are there if some begin within the segment
            some = (begin > -COARSE) & (begin - COARSE + 1 <= (size - LENGTH)[:, None]) & (where[:, None] >= 0)
            some &= (begin >= 0) & (begin + LENGTH - COARSE + 1 <= size[:, None])
            names, cores = [], []
            for a, k, own, keep in zip(first.tolist(), size.tolist(), begin, some):
                content = raw[a : a + k].tobytes()
                names.append(hashlib.blake2b(content, digest_size=16).digest())
                cores.append([hash_core(content[c : c + LENGTH - COARSE + 1], j) for j, c in enumerate(own.tolist()) if keep[j]])
            columns = [batch.column("key").take(of), fields.field("anchor"), fields.field("place"), batch.column("copies").take(of), pa.array(names, pa.binary()), pa.array(cores, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "place", "copies", "name", "cores"])

    return arrow_map(texts.select("key", "text", "copies", "segs"), run, "key binary, anchor long, place long, copies long, name binary, cores array<long>")


def hash_core(core: bytes, step: int) -> int:
    return int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=bytes([step])).digest(), "little", signed=True)


def cut_segments(texts: DataFrame) -> DataFrame:
    """(key, anchor, place, total, m, content) from texts(key, text, chosen)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, of, fields, first, size = _placed(batch, "chosen")
            for lo in range(0, len(of), 4000):
                contents = [raw[a : a + k].tobytes() for a, k in zip(first[lo : lo + 4000].tolist(), size[lo : lo + 4000].tolist())]
                part = fields.slice(lo, 4000)
                columns = [batch.column("key").take(of[lo : lo + 4000]), *[part.field(c) for c in ("anchor", "place", "total", "m")], pa.array(contents, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "place", "total", "m", "content"])

    return arrow_map(texts.select("key", "text", "chosen"), run, "key binary, anchor long, place long, total long, m long, content binary")


def _spans(hits: list[np.ndarray]) -> list[list[tuple[int, int]]]:
    """For each segment the runs of its repeated strings' places as spans of bytes, ends exclusive."""
    sizes = np.array([len(h) + 1 for h in hits])
    first = np.cumsum(sizes) - sizes + 1  # with a gap before each segment and one after the last
    apart = np.zeros(sizes.sum() + 1, dtype=bool)
    between = np.ones(len(apart), dtype=bool)
    between[first - 1] = between[-1] = False
    apart[between] = np.concatenate(hits)
    edges = np.flatnonzero(apart[1:] != apart[:-1]) + 1
    of = np.searchsorted(first, edges[::2], side="right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in hits]
    for i, a, b in zip(of.tolist(), (edges[::2] - first[of]).tolist(), (edges[1::2] - first[of] - 1 + LENGTH).tolist()):
        out[i].append((a, b))
    return out


def _common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    lo, hi = 0, n - 1  # x[:lo] are equal, x[:hi + 1] aren't
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _reach(sides: list[bytes]) -> list[int]:
    """The longest prefix that each string shares with another."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for i, j in zip(order, order[1:]):
        n = _common(sides[i], sides[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def trimmed(contents: list[bytes], where: list[int], copies: list[int]) -> list[tuple[int, bytes]]:
    """(offset, rest) of the segments of one anchor: what can't be part of a string that another of them has is cut off.

    A common string has the anchor at the same place, so it reaches from there to either side no farther than the
    segment agrees with another one.  Segments that have their anchor at several places stay whole, as do all of
    that anchor, and so do those with copies.
    """
    if min(where) < 0:
        return [(0, c) for c in contents]
    left = _reach([c[:a][::-1] for c, a in zip(contents, where)])
    right = _reach([c[a + ANCHOR :] for c, a in zip(contents, where)])
    return [(0, c) if n > 1 else (a - x, c[a - x : a + ANCHOR + y]) for c, a, n, x, y in zip(contents, where, copies, left, right)]


def repeats_of(rows: list[tuple]) -> list[tuple]:
    """(key, place, a, b) of the repeated spans in rows (anchor, key, place, total, content) of whole anchors, sorted by anchor.

    Spans count from the segment's first byte.  Segments that are equal once cut, as most of two that differ only
    beyond what they share, are one string of their added weight.
    """
    held: list[tuple[bytes, int, int, int]] = []
    number: dict[bytes, int] = {}  # of each different part, which goes through the transform once
    weights: list[int] = []
    for _, group in groupby(rows, key=lambda r: r[0]):
        own = list(group)
        parts = trimmed([r[4] for r in own], [(r[2] & 1023) - 1 for r in own], [r[3] for r in own])
        for (_, key, place, total, _), (first, content) in zip(own, parts):
            if len(content) < LENGTH:
                continue
            i = number.setdefault(content, len(weights))
            if i == len(weights):
                weights.append(0)
            weights[i] += total
            held.append((key, place, first, i))
    if not held:
        return []
    spans = _spans(repeated_starts(list(number), np.array(weights, dtype=float), LENGTH, SHARD))
    return [(key, place, first + a, first + b) for key, place, first, i in held for a, b in spans[i]]


SPANS = "key binary, place long, a long, b long"


def merged_repeats(classes: DataFrame) -> DataFrame:
    """(key, place, a, b): repeated spans in classes(anchor, key, place, total, content).

    Anchors are dealt into groups of about BLOCK bytes, which a task holds one at a time.
    """
    size = classes.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    group = F.pmod(F.xxhash64("anchor"), F.lit(max(1, size // BLOCK)))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("anchor", "ascending"), ("key", "ascending"), ("place", "ascending")])
        rows = repeats_of(list(zip(*(t.column(c).to_pylist() for c in ("anchor", "key", "place", "total", "content")))))
        kinds = (("key", pa.binary()), ("place", pa.int64()), ("a", pa.int64()), ("b", pa.int64()))
        return pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(kinds)})

    ship(classes.sparkSession)
    return classes.select(group.alias("block"), "anchor", "key", "place", "total", "content").groupBy("block").applyInArrow(run, SPANS)


def pieces_of(content: bytes, anchor: int) -> list[tuple[int, int, int, int, int, int, list[int], list[int]]]:
    """(first, strings, core, piece, strings' hashes) of a segment, hashes as two halves.

    Strings are grouped by how far before their first anchor they begin, PIECE distances to a piece; a piece's core
    is what all strings of its distances have in common, so equal strings are in pieces of equal cores.
    """
    raw = np.frombuffer(content, np.uint8)
    n = len(raw) - LENGTH + 1
    spots = np.flatnonzero(anchor_hashes(raw).view(np.int64) == anchor)
    begin = np.arange(n)
    spot = spots[np.searchsorted(spots, begin)]
    step = (spot - begin) // PIECE
    first = np.flatnonzero((np.diff(spot, prepend=-1) != 0) | (np.diff(step, prepend=-1) != 0))
    count = np.diff(first, append=n)
    core = spot[first] - PIECE * step[first]
    halves = []
    for base in (0, 1):
        spans = K.Spans(raw, base)
        span = lambda a, b: spans.of(a, b).view(np.int64).tolist()  # noqa: B023, E731
        halves.append((span(core, core + LENGTH - PIECE + 1), span(first, first + count - 1 + LENGTH), span(begin, begin + LENGTH)))
    (c0, p0, s0), (c1, p1, s1) = halves
    return [(a, k, c0[i], c1[i], p0[i], p1[i], s0[a : a + k], s1[a : a + k]) for i, (a, k) in enumerate(zip(first.tolist(), count.tolist()))]


def hashed_repeats(classes: DataFrame) -> DataFrame:
    """(key, place, a, b): repeated spans in the classes of hot anchors, by two 61-bit hashes of their strings.

    A piece whose core occurs once has no repeated string.  Equal pieces are repeated as a whole; only the strings
    of the others are looked at one by one.  A class with copies is repeated as a whole.
    """
    kinds = "key binary, place long, a long, n long, total long, c0 long, c1 long, p0 long, p1 long, s0 array<long>, s1 array<long>"
    names = [k.split()[0] for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out += [(row["key"], row["place"], a, n, row["total"], *rest) for a, n, *rest in pieces_of(row["content"], row["anchor"])]
            types = [pa.binary(), *[pa.int64()] * 8, *[pa.list_(pa.int64())] * 2]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    pieces = written(arrow_map(classes.select("key", "anchor", "place", "total", "content"), run, kinds), "suffix-pieces")
    cores = pieces.groupBy("c0", "c1").agg(F.sum("total").alias("s")).where("s > 1").select("c0", "c1")
    alive = pieces.join(cores, ["c0", "c1"], "left_semi")
    of = F.struct("key", "place", "a")
    whole = written(alive.groupBy("p0", "p1").agg(F.sum("total").alias("sum"), F.min(of).alias("at"), F.first("n").alias("n"), F.first("s0").alias("s0"), F.first("s1").alias("s1")), "suffix-pieces")
    resolved = pieces.where("total < 2").select("key", "place", "a", "n", "p0", "p1").join(whole.where("sum > 1").select("p0", "p1"), ["p0", "p1"], "left_semi")
    strings = whole.select("sum", "at.key", "at.place", "at.a", F.posexplode(F.arrays_zip("s0", "s1")).alias("i", "s")).select("sum", "key", "place", (F.col("a") + F.col("i")).alias("a"), "s.s0", "s.s1")
    again = strings.groupBy("s0", "s1").agg(F.sum("sum").alias("s")).where("s > 1").select("s0", "s1")
    single = strings.where("sum < 2").join(again, ["s0", "s1"], "left_semi")
    copied = classes.where("total > 1").select("key", "place", F.lit(0).cast("long").alias("a"), F.octet_length("content").cast("long").alias("b"))
    spans = resolved.select("key", "place", "a", (F.col("a") + F.col("n") - 1 + LENGTH).alias("b"))
    return spans.union(single.select("key", "place", "a", (F.col("a") + LENGTH).alias("b"))).union(copied)


def cut_texts(texts: DataFrame) -> DataFrame:
    """(key, n_removed, n_spans, kept_sha256) of texts(key, text, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = K.utf8(batch.column("text"))
            removed, n_spans, digests = [], [], []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text = raw[at[i] : at[i + 1]].tobytes()
                digest, end, n, gone = hashlib.sha256(), 0, 0, 0
                for s in sorted(spans, key=lambda s: (s["a"], s["b"])):
                    a, b = s["a"], s["b"]
                    if n and a <= end:  # touching spans are one
                        gone += max(0, b - end)
                        end = max(end, b)
                    else:
                        digest.update(text[end:a])
                        n, gone, end = n + 1, gone + b - a, b
                digest.update(text[end:])
                removed.append(gone)
                n_spans.append(n)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())], names=["key", "n_removed", "n_spans", "kept_sha256"])

    return arrow_map(texts.select("key", "text", "spans"), run, "key binary, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and n_kept (the bytes that stay).

    Removed is each byte that a LENGTH-byte string covers which also starts anywhere else, in the same text or
    another; matches don't cross texts, overlaps count, and strings are judged on the input.  Repeated rows are
    documents of their own and so repeat each other.  A null text is empty; texts below LENGTH bytes are never
    touched.  Nothing depends on doc_id, which may be null; other columns are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), text_key(text).alias("sha"))
    rows = rows.withColumn("key", F.substring(F.unhex("sha"), 1, 16))
    segs = written(find_segments(rows.where(F.octet_length("text") >= LENGTH)), "suffix-segments")
    several = F.col("place").bitwiseAND(1023) == 0
    shared = segs.groupBy("anchor").agg(F.count("*").alias("c"), F.bool_or(several).alias("t")).where("c > 1 or t").select("anchor")
    per_text = written(segs.join(shared, "anchor").groupBy("key").agg(F.collect_set(F.struct("place", "anchor")).alias("segs")), "suffix-kept")
    dropped(segs)
    whole = rows.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    with bucketed(whole.join(per_text, "key"), "key", "suffix_texts") as texts:  # joined by key twice more, without another shuffle
        dropped(per_text)
        spans = _repeated_spans(texts, several)
        changed = written(cut_texts(texts.join(spans, "key")), "suffix-changed")
    out = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "key", "sha").join(changed, "key", "left")
    zero = F.lit(0).cast("long")
    out = out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
    return out.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))


def _repeated_spans(texts: DataFrame, several: Column) -> DataFrame:
    """(key, spans) from texts(key, text, copies, segs): repeated spans of each text, which may overlap."""
    names = written(name_segments(texts), "suffix-names")
    totals = names.groupBy("anchor", "name").agg(F.sum("copies").alias("total"), F.min(F.struct("key", "place")).alias("at"), F.first("cores").alias("cores"))
    totals = written(totals.select("anchor", "name", "total", "at.key", "at.place", "cores"), "suffix-totals")
    classes_of = totals.where("total > 1").select("anchor", "name", F.col("key").alias("_key"), F.col("place").alias("_place"))
    members = written(names.select("key", "place", "anchor", "name").join(classes_of, ["anchor", "name"]).select("key", "place", "_key", "_place"), "suffix-members")
    dropped(names)

    # a segment goes on if it has copies, if another one of its anchor shares a core, or if its anchor stands at several places somewhere
    cores = totals.select("anchor", "key", "place", "total", F.explode("cores").alias("core"))
    met = cores.groupBy("anchor", "core").agg(F.count("*").alias("k"), F.count_if(F.col("total") < 2).alias("open")).where("k > 1 and open > 0").select("anchor", "core")
    alive = cores.join(met, ["anchor", "core"]).select("anchor", "key", "place", "total")
    loose = totals.groupBy("anchor").agg(F.bool_or(several).alias("t"), F.count_if(F.col("total") < 2).alias("open")).where("t and open > 0").select("anchor")
    copied = totals.where("total > 1").select("anchor", "key", "place", "total")
    chosen = written(alive.union(totals.join(loose, "anchor").select("anchor", "key", "place", "total")).union(copied).distinct(), "suffix-chosen")
    dropped(totals)
    sizes = chosen.groupBy("anchor").agg(F.count("*").alias("m"))
    per_text = chosen.join(sizes, "anchor").groupBy("key").agg(F.collect_list(F.struct("anchor", "place", "total", "m")).alias("chosen"))
    classes = written(cut_segments(texts.join(per_text, "key")), "suffix-classes")
    dropped(chosen)
    merged = written(merged_repeats(classes.where(F.col("m") <= HOT)), "suffix-merged")
    hashed = written(hashed_repeats(classes.where(F.col("m") > HOT)), "suffix-hashed")
    dropped(classes)

    found = merged.union(hashed)
    first = F.shiftright("place", 20)
    own = found.select("key", (first + F.col("a")).alias("a"), (first + F.col("b")).alias("b"))
    of_class = found.select(F.col("key").alias("_key"), F.col("place").alias("_place"), "a", "b")
    of_copies = members.join(of_class, ["_key", "_place"]).select("key", (first + F.col("a")).alias("a"), (first + F.col("b")).alias("b"))
    return own.union(of_copies).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


#: Every string by its digest: brute force, for small tables.
OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
w AS (SELECT r, i, md5(raw[i : i + 399]) AS h FROM (SELECT r, raw, unnest(generate_series(1, octet_length(raw) - 399)) AS i FROM d)),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT r, i FROM w SEMI JOIN twice USING (h)),
edges AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 1 ELSE 0 END AS opens FROM hit),
runs AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS k FROM edges),
spans AS (SELECT r, k, min(i) AS a, max(i) + 400 AS b FROM runs GROUP BY r, k),
ends AS (SELECT r, a, b FROM spans UNION ALL SELECT r, octet_length(raw) + 1, octet_length(raw) + 1 FROM d),
pieces AS (SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a, b), 1) AS first, a - 1 AS last FROM ends),
kept AS (SELECT r, string_agg(CASE WHEN last >= first THEN hex(raw[first : last]) ELSE '' END, '' ORDER BY a) AS h, sum(greatest(last - first + 1, 0)) AS n_kept FROM pieces JOIN d USING (r) GROUP BY r),
counts AS (SELECT r, count(*) AS n FROM spans GROUP BY r)
SELECT doc_id, octet_length(raw) AS n_bytes, CAST(octet_length(raw) - n_kept AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(h)) AS kept_sha256, CAST(n_kept AS BIGINT) AS n_kept
FROM d JOIN kept USING (r) LEFT JOIN counts USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op3_suffix_dedup": op3_suffix_dedup}
ORACLE: dict[str, str] = {"op3_suffix_dedup": OP3_SQL}
