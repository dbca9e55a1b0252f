"""Language identification with a byte convolutional network.

Bytes are embedded, filters of several widths slide over a fixed-length window, each filter's largest answer in the
window is kept and a softmax over languages reads them.  The network is trained in numpy with Adam on a bounded
sample of labelled rows; a text's verdict is the mean over all of its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slabworks.llm.common import arrow_map, packed, table
from slabworks.llm.textkit import slices

UNDETERMINED = "und"

#: Bytes of a window, without the overlap that lets filters cross into the next one.
WINDOW = 256
#: Windows that go through the network at once.
BATCH = 128
#: Labelled documents that training may use at most, shared evenly among the languages; all of their windows are used.
SAMPLE_ROWS = 1200
#: Score below which the pipeline rejects a document; an even guess among four languages has 0.25.
LEAST_SCORE = 0.35


@dataclass(frozen=True)
class Shape:
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 20
    epochs: int = 7
    step: float = 0.004
    seed: int = 7


class ByteNet:
    """The network's weights, with prediction and training."""

    def __init__(self, languages: list[str], shape: Shape = Shape()):
        self.languages = languages
        self.shape = shape
        rng = np.random.default_rng(shape.seed)
        normal = lambda *size: rng.normal(0, 1, size).astype(np.float32)
        self.w: dict[str, np.ndarray] = {"embed": normal(256, shape.embedding) * np.float32(0.5)}
        for k in shape.widths:
            self.w[f"conv{k}"] = normal(k * shape.embedding, shape.filters) / np.float32(np.sqrt(k * shape.embedding))
            self.w[f"bias{k}"] = np.zeros(shape.filters, np.float32)
        total = shape.filters * len(shape.widths)
        self.w["dense"] = normal(total, len(languages)) / np.float32(np.sqrt(total))
        self.w["out"] = np.zeros(len(languages), np.float32)
        self.w["embed"][0] = 0  # padding

    @property
    def reach(self) -> int:
        """Bytes that a window array holds: the window and the overlap."""
        return WINDOW + max(self.shape.widths) - 1

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Largest answers before the rectifier (it keeps order), where they are, and the embedded bytes."""
        e = self.w["embed"][x]
        b, n, d = e.shape
        best, where = [], []
        for k in self.shape.widths:
            cols = sliding_window_view(e.reshape(b, n * d), k * d, axis=1)[:, ::d][:, :WINDOW]
            y = cols.reshape(-1, k * d) @ self.w[f"conv{k}"]
            y = y.reshape(b, WINDOW, -1)
            best.append(y.max(axis=1) + self.w[f"bias{k}"])
            where.append(y)
        return np.concatenate(best, axis=1), where, e

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """A row of language probabilities for each window array."""
        out = [self._softmax(np.maximum(self._pooled(x[i : i + BATCH])[0], 0) @ self.w["dense"] + self.w["out"]) for i in range(0, len(x), BATCH)]
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        top, answers, e = self._pooled(x)
        hidden = np.maximum(top, 0)
        p = self._softmax(hidden @ self.w["dense"] + self.w["out"])
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        g = {"dense": hidden.T @ p, "out": p.sum(axis=0)}
        back = (p @ self.w["dense"].T) * (top > 0)
        g["embed"] = np.zeros_like(self.w["embed"])
        d, f = self.shape.embedding, self.shape.filters
        row = np.arange(len(y))[:, None]
        for j, k in enumerate(self.shape.widths):
            own = back[:, j * f : (j + 1) * f]
            at = answers[j].argmax(axis=1)
            spots = at[:, :, None] + np.arange(k)  # window, filter, byte
            seen = e[row[:, :, None], spots].reshape(len(y), f, k * d)
            g[f"conv{k}"] = np.einsum("bf,bfc->cf", own, seen)
            g[f"bias{k}"] = own.sum(axis=0)
            into = own[:, :, None] * self.w[f"conv{k}"].T[None]
            np.add.at(g["embed"], x[row[:, :, None], spots].ravel(), into.reshape(-1, d))
        g["embed"][0] = 0
        return g

    def train(self, x: np.ndarray, y: np.ndarray) -> ByteNet:
        rng = np.random.default_rng(self.shape.seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        t = 0
        for _ in range(self.shape.epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(y), 64):
                t += 1
                rows = order[i : i + 64]
                for k, g in self._gradients(x[rows], y[rows]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] -= (self.shape.step * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        return self


#: Windows that are cut at once.
BLOCK = 4_096


def windows(data: np.ndarray, at: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Window arrays of all texts (zeros after a text's end), their documents and their bytes, a block of windows at a time."""
    first = np.concatenate([[0], np.cumsum(-(-np.diff(at) // WINDOW))])
    for i in range(0, int(first[-1]), BLOCK):
        w = np.arange(i, min(i + BLOCK, int(first[-1])))
        doc = np.searchsorted(first, w, side="right") - 1
        start, end = at[doc] + (w - first[doc]) * WINDOW, at[doc + 1]
        spots = start[:, None] + np.arange(reach)
        x = np.where(spots < end[:, None], data[np.minimum(spots, len(data) - 1)], 0)
        yield x.astype(np.uint8), doc, np.minimum(WINDOW, end - start)


def predict_texts(net: ByteNet, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean language probabilities of each text; zeros for an empty one."""
    total = np.zeros((len(at) - 1, len(net.languages)))
    for x, doc, weight in windows(data, at, net.reach):
        np.add.at(total, doc, net.probabilities(x) * weight[:, None])
    return total / np.maximum(np.diff(at), 1)[:, None]


def is_held_out(doc_id) -> F.Column:
    """crc32 of the id as text leaves 0 by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, rows: int) -> list[tuple[str, str]]:
    """(lang, text) of at most ``rows`` labelled documents that aren't held out, as many of each language as there are.

    Within a language documents come in the order of a hash of doc_id.  A first pass counts the languages; a hash
    threshold made from the counts thins each of them to a few times its share before anything is sorted, so that
    no task sees a language as a whole.  With more languages than ``rows`` the most frequent ones are taken.
    """
    fit = docs.where(docs.doc_id.isNotNull() & docs.lang.isNotNull() & docs.text.isNotNull() & ~is_held_out(docs.doc_id))
    counts = fit.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()
    if not counts:
        return []
    quota = max(1, rows // len(counts))
    spark = docs.sparkSession
    wide = 1 << 30
    limits = spark.createDataFrame([(r.lang, min(wide, int(wide * (2 * quota + 40) / r.n))) for r in counts], "lang string, least long")
    rank = F.xxhash64("doc_id")
    near = fit.select("doc_id", "lang").join(F.broadcast(limits), "lang").where(F.pmod(rank, F.lit(wide)) < F.col("least")).distinct()  # ``rows`` limits at most
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(rank, F.lit(wide)), "doc_id"))
    chosen = near.withColumn("nth", nth).where(F.col("nth") <= quota).select("doc_id", "lang").collect()
    ids = spark.createDataFrame(chosen, T.StructType([docs.schema["doc_id"], docs.schema["lang"]]))
    # at most ``rows`` ids: a broadcast that doesn't grow with the data
    got = fit.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).orderBy("doc_id", "lang").collect()
    return [(r.lang, r.text) for r in got]


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, shape: Shape = Shape()) -> ByteNet | None:
    """A network trained on all windows of a sample of at most ``rows`` labelled documents that aren't held out.

    Only text and non-null lang are learned from; rows with a null doc_id, text or lang are not used, of rows with
    one doc_id and lang one text is.  Empty texts have no window.  None if there is no window to learn from.
    """
    got = sample(docs, rows)
    net = ByteNet(sorted({lang for lang, _ in got}), shape)
    texts = [text.encode() for _, text in got]
    at = np.cumsum([0, *map(len, texts)])
    cut = list(windows(np.frombuffer(b"".join(texts), np.uint8), at, net.reach))
    if not cut:
        return None
    y = np.array([net.languages.index(lang) for lang, _ in got], dtype=np.int64)[np.concatenate([doc for _, doc, _ in cut])]
    return net.train(np.concatenate([x for x, _, _ in cut]), y)


def identify(docs: DataFrame, net: ByteNet | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row with lang_pred and score.

    All windows of a whole text count.  lang_pred is ``und`` with score 0 for a null text, one without a letter,
    or if there is no network; else the language with the largest mean probability (the first in sorted order on
    a tie) and that probability.  The answer depends on the text alone; repeated rows get equal answers.
    """
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast(net)
    inside, _, name = text.rpartition(".")  # a text within a kept struct isn't sent twice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            found, scores = [], []
            letters = batch.column("_letters").to_numpy(zero_copy_only=False)
            texts = pc.struct_field(batch.column(inside), name) if inside else batch.column("_text")
            for lo, hi, data, at in slices(texts.cast(pa.string()), 1 << 17):
                p = predict_texts(own, data, at) if own else np.zeros((hi - lo, 1))
                best = p.argmax(axis=1)
                for i in range(hi - lo):
                    good = bool(letters[lo + i]) and own is not None
                    found.append(own.languages[best[i]] if good else UNDETERMINED)
                    scores.append(min(1.0, float(p[i, best[i]])) if good else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    sent = [] if inside else [F.col(text).cast("string").alias("_text")]
    return arrow_map(docs.select(*keep, letters.alias("_letters"), *sent), run, schema)


def accepted(docs: DataFrame, net: ByteNet | None, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or scored below ``least``; without a network, all stay."""
    if net is None:
        return docs
    rows = identify(packed(docs), net, text="row.text", keep=("row",))
    return rows.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("row.*")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_language_id": op1_language_id}
ORACLE: dict[str, str] = {}
