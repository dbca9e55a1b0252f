"""Ranked lexical search over inverted lists: accumulators for short lists, document-at-a-time skipping over long ones.

The index is a written table.  Documents are dealt, as they are read, to shards of at most SHARD_DOCS documents or
about SHARD_BYTES of text, and a row is one term's list in one shard: places and counts.  A very common term is so as
many rows as there are shards.  Document frequencies are sums over those rows; a shard's row with a null term has its
documents' ids and numbers of terms.

A search joins the terms of the queries to the rows and lets each shard answer all queries by itself:

* The lists of a query that are short in the shard are added up term at a time, into one list of summed scores.
* That list is then one more iterator, its greatest sum its bound, beside the long lists with the bounds of theirs.
* Documents are gone through in order, a window at a time.  Lists whose bounds together can't lift a document over the
  lowest of the k best so far don't bring up candidates; what the other lists bring up is looked up in them, largest
  bound first, and dropped as soon as the bounds that are left don't suffice.  A later document with an equal score
  ranks behind, so a bound has to be exceeded.

The k best of all shards are ranked.  Scores are whole numbers, so no order of addition changes them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slabworks.llm.common import arrow_map, table, written
from slabworks.session import ship

#: Documents and bytes of text of a shard at most; one longer text is a shard of its own.
SHARD_DOCS = 8_192
SHARD_BYTES = 8 << 20
#: Lists with at most this share of a shard's documents are short.
SHORT = 0.02
#: Documents gone through at once.
WINDOW = 1_024

#: Maximal runs of letters and digits of ASCII and of everything beyond ASCII, on UTF-8 bytes.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Bytes of text whose terms are listed at once.
_PIECE = 1 << 20


def term_counts(raw: bytes) -> Counter:
    """How often each term occurs in a text; only A to Z are lower-cased."""
    raw, out, at = raw.lower(), Counter(), 0  # bytes.lower leaves everything beyond ASCII alone
    while at < len(raw):
        end = at + _PIECE
        if end < len(raw):  # not inside a term
            run = _TERM.match(raw, end)
            end = run.end() if run else end
        out.update(_TERM.findall(raw, at, end))
        at = end
    return out


def _ordered(ids: list) -> np.ndarray:
    """Each document's place by id, null ids last; equal ids as they come."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    return place


def _shard(number: int, ids: list, lists: dict, kind: pa.DataType) -> pa.RecordBatch:
    place = _ordered(ids)
    sums = np.zeros(len(ids), np.int64)
    terms, dfs, docs, counts = [], [], [], []
    for term, (at, n) in lists.items():
        at, n = place[at], np.array(n, "<i4")
        sums[at] += n
        order = np.argsort(at)
        terms.append(term.decode("utf-8"))
        dfs.append(len(at))
        docs.append(at[order].astype("<u2").tobytes())
        counts.append(n[order].tobytes())
    own = [None] * len(ids)
    for i, p in zip(ids, place):
        own[p] = i
    nothing = [None] * len(terms)
    columns = {
        "shard": pa.array([number] * (len(terms) + 1), pa.int64()),
        "term": pa.array([*terms, None], pa.string()),
        "df": pa.array([*dfs, int((sums > 0).sum())], pa.int64()),
        "total": pa.array([*nothing, int(sums.sum())], pa.int64()),
        "docs": pa.array([*docs, None], pa.binary()),
        "counts": pa.array([*counts, sums.astype("<i8").tobytes()], pa.binary()),
        "ids": pa.array([*nothing, own], pa.list_(kind)),
    }
    return pa.RecordBatch.from_pydict(columns)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of each shard of a task's documents."""
    number, ids, lists, size = TaskContext.get().partitionId() << 32, [], {}, 0
    for batch in batches:
        kind = batch.column("doc_id").type
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            if ids and (len(ids) >= SHARD_DOCS or size + len(raw) > SHARD_BYTES):
                yield _shard(number, ids, lists, kind)
                number, ids, lists, size = number + 1, [], {}, 0
            for term, n in term_counts(raw).items():
                at, counts = lists.setdefault(term, ([], []))
                at.append(len(ids))
                counts.append(n)
            ids.append(doc)
            size += len(raw)
    if ids:
        yield _shard(number, ids, lists, kind)


def build_index(docs: DataFrame) -> DataFrame:
    """The written index of all texts of ``docs`` (doc_id, text): see above.

    A null or empty text, or one without a term, is held by its shard but counts as no document.  Repeated rows are
    documents of their own.  Other columns are not looked at; an empty table gives an empty index.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return written(arrow_map(rows, _indexed, f"shard long, term string, df long, total long, docs binary, counts binary, ids array<{kind}>"), "lexical-index")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(item, term.decode("utf-8"), n) for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()) for term, n in term_counts((text or "").encode()).items()]
        columns = list(zip(*out)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.column("item_id").type), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=["item_id", "term", "times"])


Lists = list[tuple[np.ndarray, np.ndarray]]


def summed(lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: one list of the summed scores of several lists, documents ascending."""
    docs, scores = np.concatenate([d for d, _ in lists]), np.concatenate([s for _, s in lists])
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(scores, first)


def best(lists: Lists, n_docs: int, k: int, short: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and scores of the k best with a score above 0, best first, ties to the smaller; and how many postings were read.

    A list has documents ascending and their scores; lists of at most ``short`` postings are added up first.
    """
    few = [x for x in lists if len(x[0]) <= short]
    iterators = [x for x in lists if len(x[0]) > short] + ([summed(few)] if few else [])
    iterators = sorted(((int(s.max()), d, s) for d, s in iterators if len(d)), key=lambda x: x[0])
    reach = np.cumsum([x[0] for x in iterators])  # what the first lists can add together
    edges = np.arange(0, n_docs + WINDOW, WINDOW)
    cuts = [d.searchsorted(edges) for _, d, _ in iterators]
    top, scores, least, read = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, sum(len(x[0]) for x in few)
    for w, start in enumerate(edges[:-1]):
        free = int(np.searchsorted(reach, least, side="right"))  # lists that can't lift a document over the least by themselves
        if free == len(iterators):
            break
        found = np.zeros(WINDOW, np.int64)
        for (_, d, s), cut in zip(iterators[free:], cuts[free:]):
            a, b = cut[w], cut[w + 1]
            found[d[a:b] - start] += s[a:b]
            read += b - a
        docs = np.flatnonzero(found)
        for i in range(free - 1, -1, -1):
            docs = docs[found[docs] + reach[i] > least]
            if not len(docs):
                break
            (_, d, s), a, b = iterators[i], cuts[i][w], cuts[i][w + 1]
            own = d[a:b]
            at = own.searchsorted(docs + start)
            hit = np.flatnonzero(at < len(own))
            hit = hit[own[at[hit]] == docs[hit] + start]
            found[docs[hit]] += s[a:b][at[hit]]
            read += len(docs)
        docs = docs[found[docs] > least]
        if len(docs):
            top, scores = np.append(top, docs + start), np.append(scores, found[docs])
            order = np.lexsort((top, -scores))[:k]
            top, scores = top[order], scores[order]
            least = int(scores[-1]) if len(scores) == k else 0
    return top, scores, read


def _searched(n: int, length: int, k: int) -> Callable[[pa.Table], pa.Table]:
    """The k best of one shard for each of a block of items; n documents with terms, length terms in all."""

    def run(rows: pa.Table) -> pa.Table:
        head = rows.filter(pa.compute.is_null(rows["term"]))
        rows = rows.filter(pa.compute.is_valid(rows["term"]))
        own = np.frombuffer(head["counts"][0].as_buffer(), "<i8")
        ids = head["ids"][0].as_py()
        m = 75 + (25 * own * n) // length
        items: dict = {}
        for weight, docs, counts, uses in zip(rows["weight"].to_pylist(), rows["docs"], rows["counts"], rows["uses"].to_pylist()):
            at = np.frombuffer(docs.as_buffer(), "<u2").astype(np.int64)
            tf = np.frombuffer(counts.as_buffer(), "<i4").astype(np.int64)
            score = weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[at]))
            for use in uses:
                items.setdefault(use["item_id"], []).append((at, score * use["times"]))
        out = [[], [], []]
        for item, lists in items.items():
            docs, scores, _ = best(lists, len(own), k, int(SHORT * len(own)))
            out[0] += [item] * len(docs)
            out[1] += [ids[d] for d in docs]
            out[2] += scores.tolist()
        kinds = rows.schema.field("uses").type.value_type.field("item_id").type, rows.schema.field("ids").type.value_type
        return pa.table({"item_id": pa.array(out[0], kinds[0]), "doc_id": pa.array(out[1], kinds[1]), "score": pa.array(out[2], pa.int64())})

    return run


def search(index: DataFrame, items: DataFrame, k: int = 20, block: int = 1_024) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of each item (item_id, text) with a score above 0.

    With N documents that have a term, L terms in all, a document's n terms, df documents that hold a term and tf
    times it stands in a document: the score sums w * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms,
    repeats included, where w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 75 + (25 n N) div L.  Equal scores
    rank by doc_id, null ids last.  Rows with one item_id are one item with the terms of all; rows without an
    item_id take no part.  An item without terms, or none of whose terms occur, has no row.  Other columns are not
    looked at.  Items are searched in blocks of about ``block``.
    """
    spark = index.sparkSession
    sums = index.where("term is null").agg(F.sum("df").alias("n"), F.sum("total").alias("length")).first()
    n, length = sums.n or 0, sums.length or 1
    kinds = items.schema["item_id"].dataType.simpleString(), index.schema["ids"].dataType.elementType.simpleString()
    asked = arrow_map(items.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null"), _item_terms, f"item_id {kinds[0]}, term string, times long")
    asked = written(asked.groupBy("item_id", "term").agg(F.sum("times").alias("times")), "lexical-items")
    blocks = -(-asked.select("item_id").distinct().count() // block) or 1
    lists = written(index.join(asked.select("term").distinct(), "term", "left_semi"), "lexical-lists")
    df = lists.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df") + 1)))
    asked = asked.join(df, "term").withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    uses = asked.groupBy("term", "block").agg(F.first(weight).alias("weight"), F.collect_list(F.struct("item_id", "times")).alias("uses"))
    rows = lists.drop("df", "total").join(uses, "term")
    head = index.where("term is null").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    head = head.select("shard", "block", "term", "docs", "counts", "ids")
    ship(spark)
    visits = rows.select("shard", "block", "term", "docs", "counts", "ids", "weight", "uses").unionByName(head, allowMissingColumns=True)
    found = visits.groupBy("shard", "block").applyInArrow(_searched(n, length, k), f"item_id {kinds[0]}, doc_id {kinds[1]}, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=20)


OP12_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), d AS (SELECT row_number() OVER () AS i, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
t AS (SELECT i, term, count(*) AS tf FROM (SELECT i, unnest(w) AS term FROM d) GROUP BY ALL),
s AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM d),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
q AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
    SELECT item_id, i, CAST(sum(CAST(floor(1000 * ln((2 * s.N + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * d.n * s.N) // s.L)))) AS BIGINT) AS score
    FROM q JOIN f USING (term) JOIN t USING (term) JOIN d USING (i), s GROUP BY item_id, i
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored JOIN d USING (i) WHERE score > 0
) WHERE rank <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op12_ranked_search": op12_ranked_search}
ORACLE: dict[str, str] = {"op12_ranked_search": OP12_SQL}
