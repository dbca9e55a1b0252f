"""Secret scans in SQL functions only, with corpus-wide ownership frequency.

Patterns give candidate spans.  The hash of each candidate's value is counted over the whole corpus by distinct
repositories (different texts of a source) and distinct owners (sources): a value that many owners hold, or that
stands in many repositories, is a copied example; one that few hold is a live-looking credential.

Candidates are rows from the moment they are found: places are running sums over a text's matches and overlaps are
found by a sorted sweep, so that a text with many matches costs in proportion to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slabworks.llm.common import packed, table, text_key, written

# Fixed patterns.  Both cases are spelled out: engines differ in what a case-insensitive match folds.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: A run that is too short holds no longer one, so the least length can stand in these patterns; in ASSIGN it can't.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Runs that may be a credential without a name beside them; at least one letter and one digit are asked for besides.
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "live")
PATTERNS = (ASSIGN, ACCESS, HEX, OPAQUE)
LEAST_VALUE = 12
#: A value held by at least so many owners, or that stands in so many repositories, is a copied example.
EXAMPLE_OWNERS = 4
EXAMPLE_REPOSITORIES = 20
#: Parts that a widely copied value's rows are split into where they are judged.
SALTS = 16

_HITS = "array<struct<kind:int,i:int,gap:int,hit:string>>"


def matches(text: Column, kind: int) -> Column:
    """All leftmost non-overlapping matches of a kind: struct(kind, i, gap, hit), gap being the code points before it."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)  # what stands before each match gives its place
    steps = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
    hits = F.transform(steps, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["hit"].alias("hit")))
    return F.when(text.rlike(PATTERNS[kind]), hits).otherwise(F.expr("array()").cast(_HITS))


def row_key(doc_id: Column, source: Column, text: Column) -> Column:
    """Rows of equal doc_id, source and text are one; its last 64 characters name the text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(source.cast("string"), F.lit("")), text_key(F.coalesce(text, F.lit(""))))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, owner, row_key and hits, the raw matches of all kinds."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    return docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("owner"), own.alias("row_key"), F.concat(*[matches(text, k) for k in range(4)]).alias("hits"))


def spans_of(rows: DataFrame) -> DataFrame:
    """(row_key, owner, start, kind, end, value_hash): base spans, and opaque ones that touch none of their text's base spans.

    Places are code points from 0, ends exclusive.
    """
    each = rows.where(F.size("hits") > 0).select("row_key", "owner", F.inline("hits")).dropDuplicates(["row_key", "kind", "i"])
    so_far = Window.partitionBy("row_key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("hit")
    each = each.withColumn("end", F.sum(F.col("gap") + size).over(so_far).cast("int")).withColumn("start", F.col("end") - size)
    value = F.when(F.col("kind") == 0, F.regexp_extract("hit", ASSIGN, 2)).otherwise(F.col("hit"))
    each = each.withColumn("value", value)
    good = F.when(F.col("kind") == 0, F.length("value") >= LEAST_VALUE).when(F.col("kind") == 3, F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")).otherwise(F.lit(True))
    each = each.where(good)
    by_text = Window.partitionBy("row_key")
    before = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(by_text.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(F.col("kind") < 3, F.col("start"))).over(by_text.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0))
    swept = each.withColumn("before", before).withColumn("after", after)
    apart = (F.col("kind") < 3) | (F.coalesce(F.col("before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True)))
    return swept.where(apart).select("row_key", "owner", "start", "kind", "end", F.sha2(F.col("value").cast("binary"), 256).alias("value_hash"))


def ownership(spans: DataFrame) -> DataFrame:
    """For each value hash the distinct repositories and owners that hold it; hot values are thinned before the shuffle."""
    held = spans.select("value_hash", "owner", F.substring("row_key", -64, 64).alias("repository")).distinct()
    by_owner = held.groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def find_secrets(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """One row a document: doc_id, row_key, base, and found, arrays of struct(start, kind, end, live).

    base are the spans of the three base kinds; found has them and the extra ones whose value is live-looking.  live
    is false for values that at least ``example_owners`` owners or ``example_repositories`` repositories hold.  A null
    text is empty and has no span, a null source is an owner of its own (as an empty one), repeated rows are each
    returned but counted once, a null doc_id is allowed, other columns are not looked at.  Texts are scanned whole.
    """
    rows = written(candidates(docs), "secret-candidates")
    spans = written(spans_of(rows), "secret-spans")
    copied = ownership(spans).where((F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories))
    salted = copied.select("value_hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("copied"))
    judged = spans.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(SALTS)).cast("int")).join(salted, ["value_hash", "salt"], "left")
    judged = judged.withColumn("live", F.col("copied").isNull()).where("live or kind < 3")
    per_row = judged.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("found"))
    empty = F.expr("array()").cast("array<struct<start:int,kind:int,end:int,live:boolean>>")
    out = rows.select("doc_id", "row_key").join(per_row, "row_key", "left").select("doc_id", "row_key", F.coalesce("found", empty).alias("found"))
    return out.select("doc_id", "row_key", F.filter("found", lambda s: s.kind < 3).alias("base"), "found")


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined; spans are sorted by start and kind already."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.end.cast("string"))), ",")


def redact(docs: DataFrame, found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every live span of their texts replaced by a mark; n_chars follows, all else stays.

    Spans that overlap get one mark together, spans that touch get one each.  Rows without a live span, null texts
    included, stay as they are; repeated rows are all changed alike.
    """
    live = found.select("row_key", F.explode(F.filter("found", lambda s: s.live)).alias("s")).select("row_key", "s.start", "s.end").distinct()
    in_order = Window.partitionBy("row_key").orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    live = live.withColumn("opens", (F.col("start") >= F.coalesce(reached, F.lit(0))).cast("int"))
    live = live.withColumn("nth", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    gone = live.groupBy("row_key", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    gone = gone.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("gone"))

    text, spans = F.col("text"), F.col("gone")
    last = lambda i: F.when(i > 0, F.get(spans, i - 1).end).otherwise(F.lit(0))
    pieces = F.transform(spans, lambda s, i: F.concat(F.substring(text, last(i) + 1, s.start - last(i)), F.lit(mark)))
    clean = F.concat(F.array_join(pieces, ""), F.substring(text, last(F.size(spans)) + 1, F.length(text)))
    rows = packed(docs, text=F.col("text"), row_key=row_key(F.col("doc_id"), F.col("source"), F.col("text"))).join(gone, "row_key", "left")
    rows = rows.withColumn("text", F.when(spans.isNotNull(), clean).otherwise(text))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(spans.isNotNull(), F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long")
    return out.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s.live)).cast("long").alias("n_live"),
    )


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql() -> str:
    kinds = " UNION ALL ".join(
        f"SELECT rid, doc_id, owner, repository, {k} AS kind, regexp_extract_all(text, {_sql_text(p)}) AS hits, string_split_regex(text, {_sql_text(p)}) AS gaps FROM docs" for k, p in enumerate(PATTERNS)
    )
    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(KINDS)) + " END"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, sha256(coalesce(text, '')) AS repository FROM documents),
hits AS ({kinds}),
each AS (SELECT rid, doc_id, owner, repository, kind, hits, gaps, unnest(generate_series(1, len(hits))) AS i FROM hits WHERE len(hits) > 0),
placed AS (
    SELECT rid, doc_id, owner, repository, kind, hits[i] AS hit,
           CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS first
    FROM each
), valued AS (
    SELECT rid, doc_id, owner, repository, kind, first, first + length(hit) AS last,
           CASE WHEN kind = 0 THEN regexp_extract(hit, {_sql_text(ASSIGN)}, 2) ELSE hit END AS value FROM placed
), base AS (SELECT * FROM valued WHERE kind IN (1, 2) OR kind = 0 AND length(value) >= {LEAST_VALUE}),
extra AS (
    SELECT * FROM valued v WHERE kind = 3 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = v.rid AND b.first < v.last AND v.first < b.last)
), spans AS (SELECT * FROM base UNION ALL SELECT * FROM extra),
owners AS (SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT owner || ' ' || repository) AS n_repositories FROM spans GROUP BY value),
judged AS (SELECT s.*, n_owners < {EXAMPLE_OWNERS} AND n_repositories < {EXAMPLE_REPOSITORIES} AS live FROM spans s JOIN owners USING (value)),
found AS (SELECT * FROM judged WHERE kind < 3 OR live),
per_row AS (
    SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS c, count(*) FILTER (kind = 2) AS h, count(*) FILTER (live) AS n_live,
           string_agg({names} || ':' || first || ':' || last, ',' ORDER BY first, kind) FILTER (kind < 3) AS base_text,
           string_agg({names} || ':' || first || ':' || last, ',' ORDER BY first, kind) AS spans
    FROM found GROUP BY rid
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base_text, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM docs LEFT JOIN per_row USING (rid)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op7_secrets": op7_secrets}
ORACLE: dict[str, str] = {"op7_secrets": _sql()}
