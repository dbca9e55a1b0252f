"""Benchmark decontamination in SQL functions only: size-partitioned MinHash containment search.

Test items are partitioned by their number of shingles.  A partition's sketches keep each item's smallest hashes: as
many as the partition's largest item could be missing in a document that still contains the required share, plus
SPARE.  Documents are looked up in the sketches by their shingles' hashes, and the share of an item's sketch that a
document holds estimates the containment: a document with the required share misses at most so many of the item's
hashes, retained ones included, so a pair that misses more of the sketch is dropped and none is lost, however long
the document is.  The pairs that are left are verified on the shingles themselves.

Items of fewer than WORDS words are one shingle, all of their words; documents are looked up by runs of that many
words too, if there are such items.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.llm.common import let, packed, table, text_key, written

WORDS = 5
#: The least share of an item's shingles, as a whole percentage.
PERCENT = 80
#: Hashes that a sketch keeps beyond the fewest: they make the estimate of the containment sharper.
SPARE = 3
#: Sketch rows (24 bytes each) up to which they are broadcast; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _grams(parts: Column, width: int, hashed: bool) -> Column:
    """Each run of ``width`` words, hashed or joined by spaces; empty where there are too few words."""

    def make(i: Column) -> Column:
        return F.xxhash64(*[F.element_at(parts, i + j) for j in range(width)]) if hashed else F.array_join(F.slice(parts, i, F.lit(width)), " ")

    n = F.size(parts) - (width - 1)
    kind = "array<bigint>" if hashed else "array<string>"
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), make)).otherwise(F.expr("array()").cast(kind))


def shingle_hashes(text: Column, widths: tuple[int, ...] = (WORDS,)) -> Column:
    """Hashes of all runs of each width."""
    return let(words(text), lambda parts: F.concat(*[_grams(parts, w, True) for w in widths]))


def shingles(text: Column, widths: tuple[int, ...] = (WORDS,)) -> Column:
    """All runs of each width; the words of one are joined by spaces."""
    return let(words(text), lambda parts: F.concat(*[_grams(parts, w, False) for w in widths]))


def own_width(text: Column) -> Column:
    """Words in a shingle of an item: WORDS, or all that it has."""
    return F.least(F.size(words(text)), F.lit(WORDS))


def _of_item(text: Column, width: Column, make: Callable[[Column, tuple[int, ...]], Column]) -> Column:
    out = F.when(width == 1, make(text, (1,)))
    for w in range(2, WORDS + 1):
        out = out.when(width == w, make(text, (w,)))
    return F.array_distinct(out)


def sketches(items: DataFrame) -> DataFrame:
    """(hash, item_key, size_class, least): the retained hashes of each item (item_key, text, width), by size partition.

    least is the number of them that a document with the required share has at least.
    """
    parts = items.select("item_key", _of_item(F.col("text"), F.col("width"), shingle_hashes).alias("h"))
    n = F.size("h")
    parts = parts.withColumn("size_class", F.floor(F.log2(n)).cast("int"))
    upper = F.pow(F.lit(2), F.col("size_class") + 1) - 1
    keep = F.least(F.floor(upper * (100 - PERCENT) / 100) + 1 + SPARE, n).cast("int")
    missing = F.floor(n * (100 - PERCENT) / 100)
    parts = parts.select("item_key", "size_class", F.slice(F.array_sort("h"), F.lit(1), keep).alias("h"), F.greatest(keep - missing, F.lit(1)).cast("int").alias("least"))
    return parts.select(F.explode("h").alias("hash"), "item_key", "size_class", "least")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast behind a check of its size (rows of numbers only); a larger table is left to a shuffled join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, n_item, n_shared): documents that contain PERCENT of an item's distinct shingles.

    text_key is the SHA-256 of the document's text.  Null or empty texts and those without a letter or digit match
    nothing.  A pair is returned once however often its rows are repeated; documents of one text are verified
    together and all returned, null doc_ids included.  Items with the same id are told apart by their text, and the
    best of them counts.  Long documents are searched whole; there is no limit on pairs.
    """
    named = items.select("item_id", "text").where("text is not null").distinct()
    named = named.withColumn("item_key", F.xxhash64("item_id", "text")).withColumn("width", own_width(F.col("text"))).where("width > 0")
    widths = tuple(sorted(r.width for r in named.select("width").distinct().collect())) or (WORDS,)  # WORDS at most
    sketch = written(sketches(named), "decontam-sketch")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("look")).where("text is not null")
    looked = keyed.select("look", F.explode_outer(shingle_hashes(F.col("text"), widths)).alias("hash"))  # not explode: its filter would compute all twice
    hits = looked.join(_small(sketch), "hash").select("look", "item_key", "size_class", "least", "hash").distinct()
    hits = hits.groupBy("look", "item_key", "size_class").agg(F.count("*").alias("held"), F.first("least").alias("least"))
    hits = written(hits.where("held >= least").select("look", "item_key"), "decontam-hits")

    # each document meets the shingles that its candidates want once, however many items want them
    wanted = named.select("item_id", "item_key", _of_item(F.col("text"), F.col("width"), shingles).alias("want")).withColumn("n_item", F.size("want").cast("long"))
    needed = written(hits.join(wanted, "item_key").select("look", "item_id", "item_key", "n_item", F.explode("want").alias("s")), "decontam-needed")
    per_text = needed.groupBy("look").agg(F.collect_set("s").alias("want"))
    found = keyed.join(hits.select("look").distinct(), "look", "left_semi")  # so that other texts don't move
    texts = found.join(per_text, "look").select("doc_id", "look", "text", "want", text_key(F.col("text")).alias("text_key"))
    texts = written(texts.select("doc_id", "look", "text_key", F.array_intersect("want", shingles(F.col("text"), widths)).alias("have")), "decontam-texts")
    have = texts.groupBy("look", "text_key").agg(F.first("have").alias("have")).select("look", "text_key", F.explode("have").alias("s"))
    pairs = have.join(needed, ["look", "s"]).groupBy("text_key", "item_key").agg(F.first("item_id").alias("item_id"), F.first("n_item").alias("n_item"), F.count("*").alias("n_shared"))
    pairs = pairs.where(F.col("n_shared") * 100 >= F.col("n_item") * PERCENT)
    best = F.max_by(F.struct("n_item", "n_shared"), F.struct(F.col("n_shared") / F.col("n_item"), "n_item"))
    leaks = pairs.groupBy("text_key", "item_id").agg(best.alias("b"))
    return texts.select("doc_id", "text_key").distinct().join(leaks, "text_key").select("doc_id", "text_key", "item_id", "b.n_item", "b.n_shared")


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """``docs`` without the texts that ``leaks`` names; null texts stay."""
    rows = packed(docs, text_key=text_key(F.col("text")))
    return rows.join(leaks.select("text_key").distinct(), "text_key", "left_anti").select("row.*")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "n_item", "n_shared")


OP6_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, w, least(len(w), {WORDS}) AS k FROM (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
widths AS (SELECT DISTINCT k FROM b),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, widths)),
bs AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM b)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM ds JOIN bs USING (k, s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * {PERCENT}
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op6_decontamination": op6_decontamination}
ORACLE: dict[str, str] = {"op6_decontamination": OP6_SQL}
