"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts, largest first, enter the open shard with the tightest room that still holds them; the shards'
rooms are kept in a balanced tree.  Groups of one size are alike, so the packing runs on a histogram of sizes, whose
number of entries is bounded, and its answer says which ranks within a size go to which shard.  Everything about
single documents and groups stays distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slabworks.llm.common import table, text_key, written

#: Bytes that a document takes besides its text.
OVERHEAD = 16
SHARDS = 40
#: Leading binary digits of a group's size that packing looks at; the rest is rounded up.  At most 2**16 + 2**15 * 47 classes.
DIGITS = 16
#: Parts that a hot key is split into where its rows are numbered.
SALTS = 1024


class Rooms:
    """An AVL tree of (room, shard): the tightest room for a size in logarithmic time."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root = None  # node: [key, left, right, height]

    @staticmethod
    def _h(n) -> int:
        return n[3] if n else 0

    @classmethod
    def _fixed(cls, n):
        n[3] = 1 + max(cls._h(n[1]), cls._h(n[2]))
        lean = cls._h(n[1]) - cls._h(n[2])
        for heavy, light, over in ((1, 2, lean > 1), (2, 1, lean < -1)):
            if over:
                if cls._h(n[heavy][light]) > cls._h(n[heavy][heavy]):
                    n[heavy] = cls._turned(n[heavy], light, heavy)
                return cls._turned(n, heavy, light)
        return n

    @classmethod
    def _turned(cls, n, heavy, light):
        up = n[heavy]
        n[heavy], up[light] = up[light], n
        n[3] = 1 + max(cls._h(n[1]), cls._h(n[2]))
        up[3] = 1 + max(cls._h(up[1]), cls._h(up[2]))
        return up

    def add(self, key: tuple[int, int]) -> None:
        def into(n):
            if n is None:
                return [key, None, None, 1]
            side = 1 if key < n[0] else 2
            n[side] = into(n[side])
            return self._fixed(n)

        self.root = into(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def out(n, key):
            if key == n[0]:
                if n[1] is None or n[2] is None:
                    return n[1] or n[2]
                least = n[2]
                while least[1]:
                    least = least[1]
                n[0] = least[0]
                n[2] = out(n[2], least[0])
            else:
                side = 1 if key < n[0] else 2
                n[side] = out(n[side], key)
            return self._fixed(n)

        self.root = out(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least (room, shard) with room >= size."""
        n, best = self.root, None
        while n:
            if n[0][0] >= size:
                best, n = n[0], n[1]
            else:
                n = n[2]
        return best


def best_fit_decreasing(sizes: Iterable[tuple[int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Packs (size, how many) into shards of a capacity: (size, first rank, end rank, shard) rows, shards opened.

    Equal items in a row go on entering the shard that the first entered, for it stays the tightest that fits.
    """
    rooms, opened, out = Rooms(), 0, []
    for size, n in sorted(sizes, reverse=True):
        if size > capacity:
            raise ValueError("an item is larger than a shard")
        rank = 0
        while rank < n:
            found = rooms.tightest(size)
            if found is None:
                found = (capacity, opened)
                opened += 1
            else:
                rooms.remove(found)
            room, shard = found
            k = min(n - rank, room // size) if size else n - rank
            out.append((size, rank, rank + k, shard))
            rooms.add((room - k * size, shard))
            rank += k
    return out, opened


def rounded(size: Column) -> Column:
    """A size rounded up to DIGITS leading binary digits."""
    unit = F.greatest(F.lit(0), F.length(F.bin(size)) - DIGITS)
    step = F.call_function("shiftleft", F.lit(1).cast("long"), unit)
    return (F.floor((size + step - 1) / step) * step).cast("long")


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: each row's place from 0 among the rows of its key.  Hot keys are numbered in SALTS parts."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy(key, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select(key, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)) - 1
    return salted.withColumn("_within", within).join(first, [key, "_salt"]).withColumn(name, (F.col("_first") + F.col("_within")).cast("long")).drop("_salt", "_within", "_first")


def pack(sizes: list[tuple[int, int]], large: list[tuple[str, int, int]], shards: int) -> tuple[list, list, int]:
    """Packs into at most ``shards`` shards of the least capacity found.

    sizes: (group size, how many).  large: (key, copies, bytes of one) of groups beyond an even share, which no near
    equal sharding can hold whole: they alone are cut, into pieces that fill a shard.  Returns the runs of ranks by
    size, the runs of ranks by large group's key, and the capacity.
    """
    total = sum(s * n for s, n in sizes) + sum(n * s for _, n, s in large)
    least = max([-(-total // shards), *(s for s, _ in sizes), *(s for *_, s in large), 1])
    slack = 0
    while True:
        capacity = least + slack
        pieces: dict[int, list[tuple[str, int, int]]] = {}
        for key, n, size in large:
            most = capacity // size
            for first in range(0, n, most):
                k = min(most, n - first)
                pieces.setdefault(k * size, []).append((key, first, first + k))
        counted = dict(sizes)
        for size, own in pieces.items():
            counted[size] = counted.get(size, 0) + len(own)
        runs, opened = best_fit_decreasing(counted.items(), capacity)
        if opened <= shards:
            break
        slack = max(2 * slack, -(-least // 1_000_000))
    by_size, by_key = [], []
    for size, first, end, shard in runs:
        n = len(own := pieces.get(size, ()))  # pieces take the first ranks of their size
        by_key += [(*own[i], shard) for i in range(first, min(end, n))]
        if end > n:
            by_size.append((size, max(first, n) - n, end - n, shard))
    return by_size, by_key, capacity


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each row; shards are nearly equal in bytes.

    A group is all rows of one text (null and empty texts are one group) and is never divided unless its bytes
    exceed an even share of all bytes; such a group is cut by rows into pieces of a shard's capacity.  The capacity
    is the least tried from total / shards upwards with which best-fit-decreasing opens at most ``shards`` shards;
    fewer are opened where there are few groups.  Ties in size are broken by the text's hash, slots follow doc_id
    within 1024 hashed parts of a shard; repeated rows take slots of their own.  Null doc_ids are allowed; other
    columns are not looked at.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_key(text).alias("text_key"))
    rows = written(rows, "shard-rows")
    groups = rows.groupBy("text_key").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    groups = written(groups.select("text_key", "n", "size", rounded(F.col("n") * F.col("size")).alias("total")), "shard-groups")
    share = groups.agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0
    share = max(1, -(-share // shards))
    is_large = (F.col("total") > share) & (F.col("n") > 1)
    large = [tuple(r) for r in groups.where(is_large).select("text_key", "n", "size").orderBy("text_key").collect()]  # fewer than 2 x shards
    sizes = [tuple(r) for r in groups.where(~is_large).groupBy("total").agg(F.count("*")).collect()]  # bounded by DIGITS
    by_size, by_key, _ = pack(sizes, large, shards)

    runs = spark.createDataFrame(by_size, "total long, first long, end long, shard int")
    placed = numbered(groups.where(~is_large), "total", ["text_key"], "rank").join(runs, "total").where("rank >= first and rank < end").select("text_key", "shard")
    whole = rows.join(placed, "text_key").select("doc_id", "size", "text_crc32", "text_key", "shard")
    pieces = spark.createDataFrame(by_key, "text_key string, first long, end long, shard int")
    keys = pieces.select("text_key").distinct()
    # fewer than 2 x shards keys and at most 3 x shards pieces: broadcasts that don't grow with the data
    cut = numbered(rows.join(F.broadcast(keys), "text_key", "left_semi"), "text_key", ["doc_id"], "rank").join(F.broadcast(pieces), "text_key").where("rank >= first and rank < end")
    both = whole.unionByName(cut.select(*whole.columns))
    return numbered(both, "shard", ["doc_id", "text_key"], "slot").select("doc_id", "size", "text_crc32", "shard", "slot")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op5_sharding": op5_sharding}
ORACLE: dict[str, str] = {}
