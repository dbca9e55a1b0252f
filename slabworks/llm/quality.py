"""Quality rules: plain counts of each text, and a log-likelihood ratio of hashed byte n-grams.

Two multinomials over the same hash buckets are counted over all data: one over the raw corpus, one over the
documents that the labels trust.  A text's score is the mean over its n-grams of log(target / raw); every document
gets its verdict by comparing the score with a fixed threshold, never by chance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slabworks.llm import textkit as K
from slabworks.llm.common import arrow_map, table

#: Bytes in an n-gram, hash buckets, pseudo-count of a bucket, and the least score of a kept text.
ORDER = 4
BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.45

#: The characters counted by n_symbols.
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def base_counts(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The five base counts of each text."""
    n = len(at) - 1
    nonspace = ~K.SPACE[data]
    starts, ends, doc = K.words(data, at)
    spans = K.Spans(data)
    out = {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": _sums(nonspace & K.LEAD[data], at),
        "n_symbols": _sums(SYMBOLS[data], at),
    }
    line_from, line_to = K.runs(data != 10, at)
    seen = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(nonspace, out=seen[1:])
    full = seen[line_to] > seen[line_from]
    line_from, line_to = line_from[full], line_to[full]
    line_doc = K.document_of(line_from, at)
    out["n_dup_lines"] = np.bincount(line_doc[_repeated_lines(data, line_from, line_to, line_doc, spans)], minlength=n)
    out["n_repeat_words"] = np.bincount(doc[_repeated_words(data, starts, ends, doc, spans)], minlength=n)
    return out


def _repeated_lines(data: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray, spans: K.Spans) -> np.ndarray:
    """Whether each line equals an earlier one of its text; lines of equal hash are compared by their bytes."""
    _, rep, of = np.unique(K.mix(spans.of(first, last) ^ K.mix(doc.astype(K.U64))), return_index=True, return_inverse=True)
    rep = rep[of]
    again = np.flatnonzero(rep != np.arange(len(doc)))
    a, b = again, rep[again]
    out = np.zeros(len(doc), dtype=bool)
    if (doc[a] == doc[b]).all() and (last[a] - first[a] == last[b] - first[b]).all() and K.same_spans(data, first[a], first[b], last[a] - first[a]):
        out[again] = True
        return out
    seen = set()
    for i, line in enumerate(zip(doc.tolist(), (data[x:y].tobytes() for x, y in zip(first, last)))):
        out[i] = line in seen
        seen.add(line)
    return out


def _repeated_words(data: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray, spans: K.Spans) -> np.ndarray:
    """Whether each word is in a 3-word window that its text has at least twice; windows of equal hash are compared."""
    out = np.zeros(len(doc), dtype=bool)
    inside = np.flatnonzero(doc[:-2] == doc[2:]) if len(doc) >= 3 else np.zeros(0, np.int64)
    if not len(inside):
        return out
    key = K.mix(K.window_hash(spans.of(first, last), 3)[inside] ^ K.mix(doc[inside].astype(K.U64)))
    _, rep, of, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[of] >= 2)
    a, b = inside[again], inside[rep[of[again]]]
    size = last - first
    if (doc[a] == doc[b]).all() and all((size[a + j] == size[b + j]).all() and K.same_spans(data, first[a + j], first[b + j], size[a + j]) for j in range(3)):
        for j in range(3):
            out[a + j] = True
        return out
    windows: dict[tuple, list[int]] = {}
    for i in inside.tolist():
        windows.setdefault((doc[i], *(data[first[i + j] : last[i + j]].tobytes() for j in range(3))), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            for j in range(3):
                out[np.array(places) + j] = True
    return out


def ngrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte, and whether it lies within one text."""
    n = len(data) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    x = np.zeros(n, dtype=np.uint32)
    for j in range(ORDER):
        x = x * np.uint32(0x01000193) + data[j : j + n]
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    bucket = (x >> np.uint32(32 - (BUCKETS.bit_length() - 1))).astype(np.int64)
    inside = np.ones(n, dtype=bool)
    for j in range(1, ORDER):
        cut = at[1:-1] - j
        inside[cut[(cut >= 0) & (cut < n)]] = False
    return bucket, inside


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of all texts' n-grams by bucket: a fixed number of rows leaves each task and reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, data, at in K.slices(batch.column(0)):
                bucket, inside = ngrams(data, at)
                total += np.bincount(bucket[inside], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    rows = arrow_map(docs.select(F.col(text).cast("string")), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


@dataclass(frozen=True)
class Ratio:
    """log(target / raw) by bucket; None if either has no n-gram."""

    table: np.ndarray | None

    @classmethod
    def of(cls, target: np.ndarray, raw: np.ndarray) -> Ratio:
        if not target.sum() or not raw.sum():
            return cls(None)
        # the target is part of the corpus: shrink towards the raw share, so that unseen buckets stay finite
        share = raw / raw.sum()
        t = (target + SMOOTHING * BUCKETS * share) / (target.sum() + SMOOTHING * BUCKETS)
        with np.errstate(divide="ignore", invalid="ignore"):
            return cls(np.where(share > 0, np.log(t / share), 0.0))

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean log ratio of each text; 0 for one shorter than an n-gram, or without a model."""
        if self.table is None or len(data) < ORDER:
            return np.zeros(len(at) - 1)
        bucket, inside = ngrams(data, at)
        each = np.zeros(len(data))
        each[: len(bucket)] = np.where(inside, self.table[bucket], 0.0)
        # a sum of each text's own, so that a score doesn't hang on what else is in the slice; an empty text has none
        some = np.flatnonzero(np.diff(at) > 0)
        total = np.zeros(len(at) - 1)
        total[some] = np.add.reduceat(each, at[some]) if len(some) else 0.0
        return np.round(total / np.maximum(np.diff(at) - ORDER + 1, 1), 9)


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled as good and not as toxic, by a join that shuffles at every size (labels grow with the corpus).

    A null toxic label counts as none; rows with a null quality or doc_id trust nothing.  A document is trusted if any of its
    labels says so and stands there once however often it is labelled; repeated documents are each trusted.
    """
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    return docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left_semi")


def fit(docs: DataFrame, target: DataFrame) -> Ratio:
    """The ratio of the two tables' n-gram counts; null and short texts have none, repeated rows count each time."""
    return Ratio.of(bucket_counts(target), bucket_counts(docs))


def judge(docs: DataFrame, ratio: Ratio, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` of each row with the base counts, base_failed, score and kept.

    A null text has no words; with an empty one and any of fewer than 50 words it fails the base rules.  kept is
    false where the base rules fail, else whether the score reaches the threshold (ties are kept).  Without trusted
    documents all scores are 0, which is above the threshold.  Rows are judged one by one: repeated rows get equal
    verdicts; other columns are not looked at.  Memory is bounded by the longest text.
    """
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in BASE_COLUMNS], T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    model = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for _, _, data, at in K.slices(batch.column("_text")):
                parts.append(base_counts(data, at) | {"score": model.value.scores(data, at)})
            if not parts:
                continue
            x = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
            failed = (x["n_words"] < 50) | (100 * x["n_repeat_words"] > 50 * x["n_words"])
            columns = [*[x[c].astype(np.int64) for c in BASE_COLUMNS], failed, x["score"], ~failed & (x["score"] >= threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, columns)], names=schema.names)

    return arrow_map(docs.select(*keep, F.col(text).cast("string").alias("_text")), run, schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = judge(docs, fit(docs, trusted(docs, table(spark, sf_dir, "labels"))))
    return out.withColumn("score", F.round("score", 6))


OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM d),
tri AS (SELECT r, i, w[i : i + 2] AS t FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM words)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM tri) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM again, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (SELECT r, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM words),
bytes AS (SELECT r, unnest(b) AS b, unnest(range(len(b))) AS i FROM (SELECT r, regexp_extract_all(hex(encode(text)), '..') AS b FROM d)),
four AS (SELECT r, ('0x' || b)::UBIGINT AS b0, ('0x' || lead(b, 1) OVER s)::UBIGINT AS b1, ('0x' || lead(b, 2) OVER s)::UBIGINT AS b2, ('0x' || lead(b, 3) OVER s)::UBIGINT AS b3 FROM bytes WINDOW s AS (PARTITION BY r ORDER BY i)),
mixed AS (SELECT r, (((b0 * 16777619 % 4294967296 + b1) * 16777619 % 4294967296 + b2) * 16777619 % 4294967296 + b3) % 4294967296 AS x FROM four WHERE b3 IS NOT NULL),
grams AS (SELECT r, (xor(x, x >> 15) * 2246822507::UBIGINT % 4294967296) >> 16 AS bucket FROM mixed),
good AS (SELECT r FROM d SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1 AND coalesce(toxic, 0) = 0) g USING (doc_id)),
raw AS (SELECT bucket, count(*)::DOUBLE AS n FROM grams GROUP BY bucket),
target AS (SELECT bucket, count(*)::DOUBLE AS n FROM grams SEMI JOIN good USING (r) GROUP BY bucket),
sums AS (SELECT (SELECT sum(n) FROM raw) AS nr, (SELECT coalesce(sum(n), 0) FROM target) AS nt),
ratio AS (SELECT bucket, CASE WHEN nt > 0 THEN ln((coalesce(t.n, 0) + {BUCKETS} * (raw.n / nr)) / (nt + {BUCKETS}) / (raw.n / nr)) ELSE 0 END AS v FROM raw LEFT JOIN target t USING (bucket), sums),
scores AS (SELECT r, avg(v) AS score FROM grams JOIN ratio USING (bucket) GROUP BY r),
every AS (SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words, coalesce(score, 0) AS score
  FROM d JOIN base USING (r) LEFT JOIN lines l USING (r) LEFT JOIN rep p USING (r) LEFT JOIN scores USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(score, 6) AS score, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND score >= {THRESHOLD} AS kept FROM every
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op4_quality": op4_quality}
ORACLE: dict[str, str] = {"op4_quality": OP4_SQL}
