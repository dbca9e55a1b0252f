"""Approximate nearest neighbours by a forest of hash prefixes.

Vectors are dealt to shards of bounded size.  A shard holds TREES sorted arrays of BITS-bit hash strings; a bit is the
side of a random hyperplane, and the planes of a tree are orthogonal in blocks of the dimension.  A query descends
each array to its longest matching prefix and then ascends in all trees at once, one prefix length for all; every
vector that shares a prefix of that length with it in any tree is a candidate and is scored on the original vectors.

When to stop is decided by the query's own candidates, not by their number: a vector at an angle t shares x bits with
the query in some tree with a chance of 1 - (1 - (1 - t / pi) ** x) ** TREES.  A query ascends until that chance is
1 - MISS or more for vectors as near as the last of the k best it has found.  Close neighbours are so found among few
candidates; where nothing is near (vectors without structure), most of a shard is scored, at worst all of it.  No
candidate of the level reached is left out.

Every query visits every shard of its dimension; rows of a shard come before its queries, which stream through.
Equal vectors are one entry of a shard with their k + 1 smallest ids: a greater id can't be among the k nearest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slabworks.llm.common import arrow_map, table, written

TREES = 32
BITS = 64
#: The chance that a neighbour as near as the last one found is overlooked.
MISS = 0.03
#: Dimensions up to which their numbers of shards are broadcast; beyond, they are joined by a shuffle.
MOST_DIMENSIONS = 10_000
#: Different vectors of a shard, about.
SHARD_ROWS = 16_384


@lru_cache(maxsize=4)
def planes(dim: int, trees: int) -> np.ndarray:
    """Normals of the hyperplanes, (dim, trees * BITS); the same in every task."""
    rng = np.random.Generator(np.random.PCG64(20_231 + dim))
    out = []
    while sum(x.shape[1] for x in out) < trees * BITS:
        out.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    return np.concatenate(out, axis=1)[:, : trees * BITS]


def hash_strings(units: np.ndarray, trees: int) -> np.ndarray:
    """(n, trees) strings of BITS bits as unsigned numbers, whose order is that of the strings."""
    out = np.empty((len(units), trees), np.uint64)
    for a in range(0, len(units), 2048):
        bits = np.packbits(units[a : a + 2048] @ planes(units.shape[1], trees) > 0, axis=1)
        out[a : a + 2048] = bits.view(">u8").astype(np.uint64)
    return out


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component near 1: no rounding, no overflow of squares."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES):
        self.vectors = scaled(vectors.astype(np.float64))
        self.norms = lengths(self.vectors)
        self.units = self.vectors / self.norms[:, None]
        strings = hash_strings(self.units, trees)
        self.trees = trees
        self.order = np.argsort(strings, axis=0, kind="stable").T.copy()
        self.strings = np.take_along_axis(strings, self.order.T, axis=0).T.copy()

    def _level(self, cosine: float, miss: float) -> int:
        """The longest prefix at which a vector of this cosine is shared by some tree with a chance of 1 - miss."""
        p = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi
        each = 1 - miss ** (1 / self.trees)
        return BITS if p >= 1 else int(min(BITS, np.floor(np.log(each) / np.log(max(p, 1e-9)))))

    def search(self, vector: np.ndarray, strings: np.ndarray, k: int, miss: float = MISS) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and cosines of what may be among the k nearest (ties included), and how many rows were scored."""
        n, length = len(self.units), BITS - np.arange(BITS + 1, dtype=np.uint64)
        free = np.where(length >= BITS, np.uint64(2**64 - 1), (np.uint64(1) << (length % np.uint64(BITS))) - np.uint64(1))
        lo, hi = np.empty((self.trees, BITS + 1), np.int64), np.empty((self.trees, BITS + 1), np.int64)
        for t in range(self.trees):  # column x: the rows that share x bits
            lo[t] = np.searchsorted(self.strings[t], strings[t] & ~free)
            hi[t] = np.searchsorted(self.strings[t], strings[t] | free, side="right")
        shared = np.flatnonzero((hi > lo).any(axis=0))
        level = int(shared[-1])  # the longest prefix found in any tree
        unit = vector / lengths(vector[None])[0]
        seen, scores, rows = np.zeros(n, bool), np.zeros(0), np.zeros(0, np.int64)
        while True:
            near = np.zeros(n, bool)
            for t in range(self.trees):
                near[self.order[t, lo[t, level] : hi[t, level]]] = True
            fresh = np.flatnonzero(near & ~seen)
            seen |= near
            scores, rows = np.append(scores, self.units[fresh] @ unit), np.append(rows, fresh)
            last = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -2.0
            keep = scores >= last - 1e-9
            scores, rows = scores[keep], rows[keep]
            if level == 0:
                break
            # too few: one step up; enough: up to where the last of them would be found
            wanted = level - 1 if last == -2.0 else self._level(last, miss)
            if last != -2.0 and wanted >= level:
                break
            level = max(0, wanted)
        own = lengths(vector[None])[0]
        exact = (self.vectors[rows] * vector).sum(axis=1) / (self.norms[rows] * own)
        return rows, np.clip(exact, -1, 1), int(seen.sum())


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _visits(k: int, trees: int, miss: float) -> Callable:
    """Shards in a row, each its entries first and then its queries; the nearest entries of each query."""

    def matrix(col: pa.Array, dim: int) -> np.ndarray:
        return np.asarray(col.flatten()).astype(np.float64).reshape(len(col), dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, ids, forest = None, [], [], None
        for batch in batches:
            shards, kinds = np.asarray(batch.column("shard")), np.asarray(batch.column("kind"))
            dims = np.asarray(batch.column("dim"))
            change = (np.diff(shards) != 0) | (np.diff(kinds) != 0) | (np.diff(dims) != 0)
            cuts = np.flatnonzero(np.concatenate([[True], change, [True]]))
            for a, b in zip(cuts, cuts[1:]):
                part, dim = batch.slice(a, b - a), int(dims[a])
                if (dim, shards[a]) != key:
                    key, parts, ids, forest = (dim, shards[a]), [], [], None
                vectors = matrix(part.column("vec"), dim)
                if kinds[a] == 0:
                    parts.append(vectors)
                    ids += part.column("ids").to_pylist()
                    continue
                if not parts:
                    continue
                if forest is None:
                    forest = Forest(np.concatenate(parts), trees)
                out = [[], [], [], []]
                vectors = scaled(vectors)
                strings = hash_strings(vectors / lengths(vectors)[:, None], trees)
                for query, v, s in zip(part.column("ids").to_pylist(), vectors, strings):
                    rows, cosines, looked = forest.search(v, s, min(k + 1, len(ids)), miss)
                    best = sorted(zip(-cosines, (ids[r][0] for r in rows), rows))[: k + 1]
                    for c, _, r in best:
                        for values, x in zip(out, (query[0], -c, ids[r], looked)):
                            values.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.column("ids").type.value_type), pa.array(out[1], pa.float64()), pa.array(out[2], batch.column("ids").type), pa.array(out[3], pa.int64())], names=["query_id", "score", "ids", "looked"])

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, miss: float = MISS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine) of the k nearest rows found for each query, ties to the smaller vec_id.

    Both tables have vec_id and embedding; other columns are not looked at.  Null, empty and zero vectors and those
    with a null or non-finite component take no part, nor do rows without a vec_id.  Vectors are compared with those
    of their own dimension.  A row with the query's vec_id is never its neighbour; repeated rows count once, and a
    vec_id with several vectors is as near as the nearest of them.  A query with fewer than k others gets all of
    them, one with none gets no row; an empty table gives an empty result.
    """
    both = []
    for frame in (rows, queries):
        frame = frame.select("vec_id", F.col("embedding").alias("vec")).where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
        both.append(frame.select("vec_id", "vec", F.size("vec").alias("dim")))
    entries, asked = both
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = entries.distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    few = few.groupBy("vec", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    few = written(few, "forest-entries")
    shards = few.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    if shards.count() <= MOST_DIMENSIONS:
        shards = F.broadcast(shards)  # two numbers a dimension
    dealt = few.join(shards, "dim").select("dim", F.pmod(F.xxhash64(F.element_at("ids", 1)), "shards").cast("int").alias("shard"), F.lit(0).alias("kind"), "ids", "vec")
    asking = asked.distinct().join(shards, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("kind"), F.array("vec_id").alias("ids"), "vec")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    visits = dealt.unionByName(asking).repartition(parts, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    kind = rows.schema["vec_id"].dataType.simpleString()
    found = arrow_map(visits, _visits(k, trees, miss), f"query_id {kind}, score double, ids array<{kind}>, looked long")
    pairs = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 50 = 0"), k=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op11_nearest_neighbours": op11_nearest_neighbours}
ORACLE: dict[str, str] = {}
