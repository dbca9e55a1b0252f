"""Choices of columns and layers, labels of slices, and rules that read settings out of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit

# Names under which things stand, in order of preference.
COUNT_LAYERS = ("counts", "counts_X", "raw_counts", "count", "raw")
LABEL_COLUMNS = ("celltype", "annotation", "anno", "Annotation_2_tissue", "lineage", "cluster")
MITO_PREFIXES = ("mt-", "mt.", "mt:", "mt_", "mito-")
TRUTHY = ("1", "true", "yes", "y", "t")
CAPTURE = ("median_total_counts", "median_n_genes", "zero_fraction", "library_complexity", "detected_gene_fraction", "local_low_depth_fraction", "regional_low_depth_cluster_fraction", "median_pct_mito")


def count_layer(available: list[str], wanted: str | None = None) -> str:
    """The layer that counts are read from: the one asked for (which must be there), else the first known, else X."""
    if wanted is not None:
        if wanted != "X" and wanted not in available:
            raise ValueError(f"no layer {wanted}")
        return wanted
    return next((c for c in COUNT_LAYERS if c in available), "X")


def label_column(available: list[str]) -> str | None:
    return next((c for c in LABEL_COLUMNS if c in available), None)


def coordinate_columns(available: list[str], explicit: tuple[str, str] | None = None) -> tuple[str, str]:
    """The pair of columns that hold x and y: the given one, else the first known pair that is there."""
    pairs = [explicit] if explicit else [("raw_x", "raw_y"), ("x", "y"), ("array_col", "array_row"), ("pxl_col_in_fullres", "pxl_row_in_fullres"), ("center_x", "center_y")]
    for p in pairs:
        if all(c in available for c in p):
            return p
    raise ValueError("no coordinates")


def first_finite(frame: DataFrame, columns: list[str]) -> str | None:
    """The first of the columns that is there and has a finite number in it."""
    have = [c for c in columns if c in frame.columns]
    if not have:
        return None
    good = frame.agg(*[F.bool_or(F.col(c).try_cast("double").isNotNull() & ~F.isnan(F.col(c).try_cast("double"))).alias(c) for c in have]).first()
    return next((c for c in have if good[c]), None)


def slice_labels(points: DataFrame, columns: tuple[str, ...], stem: str) -> DataFrame:
    """Adds slice_label: the first of the columns that is set, else z, if it has more than one and not too many values, else the file's stem.

    Too many are more than 500 and more than four times the root of the number of points.
    """
    known = F.coalesce(*[F.col(c).cast("string") for c in columns if c in points.columns], F.lit(None).cast("string"))
    if "z" not in points.columns:
        return points.withColumn("slice_label", F.coalesce(known, F.lit(stem)))
    kinds = points.agg(F.countDistinct("z").alias("_k"), F.count("*").alias("_n"))
    usable = (F.col("_k") > 1) & (F.col("_k") <= F.greatest(F.lit(500), F.floor(F.sqrt("_n")) * 4))
    z = F.concat(F.lit("z"), F.regexp_replace(F.format_string("%.6f", F.col("z").cast("double")), r"\.?0+$", ""))
    return points.crossJoin(F.broadcast(kinds)).withColumn("slice_label", F.coalesce(known, F.when(usable & F.col("z").isNotNull(), z), F.lit(stem))).drop("_k", "_n")  # one row


def is_mito(gene: Column) -> Column:
    low = F.lower(gene)
    out = F.lit(False)
    for p in MITO_PREFIXES:
        out = out | low.startswith(p)
    return out


def mito_share(cells: DataFrame, column: str = "pct_mito") -> DataFrame:
    """Shares as fractions: a column whose median is above 1.5 is in per cent."""
    mid = cells.agg(F.percentile(column, lit(0.5)).alias("_m"))
    return cells.crossJoin(F.broadcast(mid)).withColumn(column, F.when(F.col("_m") > 1.5, F.col(column) / 100).otherwise(F.col(column))).drop("_m")  # one row


def capture_available(slices: DataFrame, declared: str = "capture_available") -> DataFrame:
    """Capture metrics become NULL where counts aren't captured expression (labels one-hot, or declared so)."""
    return slices.withColumns({c: F.when(F.coalesce(F.col(declared), F.lit(True)), F.col(c)) for c in CAPTURE if c in slices.columns})


def truth(text: Column) -> Column:
    """Whether a text says yes; NULL for none."""
    return F.when(text.isNotNull(), F.lower(F.trim(text)).isin(*TRUTHY))


def count_semantics(rows: DataFrame, by: str, flag: str) -> DataFrame:
    """(by, semantics): all, none or mixed, by whether all, none or some of a group's files hold counts."""
    kind = F.when(F.bool_and(flag), "all_count_like").when(~F.bool_or(flag), "none_count_like").otherwise("mixed")
    return rows.groupBy(by).agg(F.count("*").alias("files"), kind.alias("semantics"))


def source_contract(text: Column) -> Column:
    """Struct (place, name, axes) of a source such as ``obs:x`` or ``obsm:spatial[:,2]``; NULL for anything else."""
    pattern = r"^(obs|obsm|layer):([^\[]+)(?:\[:,\s*(\d+)\])?$"
    place, name, axes = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    return F.when(place != "", F.struct(place.alias("place"), name.alias("name"), F.when(axes != "", axes.cast("int")).alias("axes")))


def group_subset(rows: DataFrame, label: str, wanted: list[str]) -> DataFrame:
    """Rows of the wanted labels; a wanted label without a row is an error."""
    missing = set(wanted) - {r[0] for r in rows.where(F.col(label).isin(wanted)).select(label).distinct().collect()}
    if missing:
        raise ValueError(f"no rows of {', '.join(sorted(missing))}")
    return rows.where(F.col(label).isin(wanted))


def category_selections(rows: DataFrame, label: str, selections: list[str], least: int) -> DataFrame:
    """(name, points, ok) of selections such as ``front=a|b``; names differ, whatever their case, and ok asks for ``least`` points."""
    pairs = []
    for s in selections:
        name, _, values = s.partition("=")
        if not name.strip() or not values:
            raise ValueError(f"not a selection: {s}")
        pairs += [(name.strip(), v) for v in values.split("|")]
    names = list(dict.fromkeys(n for n, _ in pairs))
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("names differ by case only")
    table = rows.sparkSession.createDataFrame(pairs, "name string, _v string")
    counts = rows.groupBy(F.col(label).cast("string").alias("_v")).agg(F.count("*").alias("n"))
    out = F.broadcast(table).join(counts, "_v", "left").groupBy("name").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("points"))  # as many rows as were asked for
    return out.withColumn("ok", F.col("points") >= least)


def colour_kind(frame: DataFrame, column: str, most: int = 100) -> str:
    """``numeric`` for numbers with more than ``most`` values, else ``categorical``; a column without a value is an error."""
    kind = frame.schema[column].dataType.simpleString()
    n = frame.agg(F.countDistinct(column)).first()[0]
    if not n:
        raise ValueError(f"{column} has no value")
    numeric = kind in ("double", "float", "bigint", "int", "smallint", "tinyint") or kind.startswith("decimal")
    return "numeric" if numeric and n > most else "categorical"


def displacement(frame: DataFrame, mapped: tuple[str, str, str] | None = None, vector: str | None = None) -> Column:
    """Length of a vector column, or of the way from x, y, z to mapped coordinates."""
    if vector is not None:
        return F.sqrt(F.aggregate(vector, lit(0), lambda acc, v: acc + v * v))
    return F.sqrt(sum(((F.col(m) - F.col(a)) ** 2 for a, m in zip("xyz", mapped)), lit(0)))


def set_path(config: dict, path: str, value=None, delete: bool = False) -> dict:
    """A copy of nested settings with one dotted path set, or deleted; deleting what isn't there is an error."""
    head, _, rest = path.partition(".")
    out = dict(config)
    if rest:
        inner = out.get(head, {})
        if not isinstance(inner, dict):
            raise ValueError(f"{head} holds no settings")
        out[head] = set_path(inner, rest, value, delete)
    elif delete:
        if head not in out:
            raise KeyError(head)
        del out[head]
    else:
        out[head] = value
    return out


def sorted_id_digest(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """(by, digest): SHA-256 of a group's ids in order, as a JSON list; a group is a slice, whose ids one row can hold."""
    return rows.groupBy(*by).agg(F.sha2(F.to_json(F.array_sort(F.collect_list(F.col(key).cast("string")))).cast("binary"), 256).alias("digest"))


def adaptive_number(x: Column) -> Column:
    """A number as short text: none for a missing one, thousands whole, others with three significant places or so."""
    size = F.abs(x)
    text = lambda form, places: F.format_string(form, F.round(x, places))  # noqa: E731  ties go away from zero
    return F.when(x.isNull(), "none").when(size >= 1000, text("%,.0f", 0)).when(size >= 10, text("%.1f", 1)).when(size >= 0.01, text("%.3f", 3)).when(size == 0, "0").otherwise(F.format_string("%.2e", x))


def evidence_text(metric: Column, value: Column, expected: Column) -> Column:
    """One sentence on how a slice's metric compares with what its neighbours let expect."""
    change = (value - expected) / F.greatest(F.abs(expected), lit(2.220446049250313e-16)) * 100
    way = F.when(value < expected, "below").otherwise("above")
    return F.when(expected.isNull() | value.isNull(), F.concat(metric, F.lit(": no comparison"))).otherwise(F.concat(metric, F.lit(" is "), adaptive_number(value), F.lit(", "), F.format_string("%.0f", F.round(F.abs(change))), F.lit("% "), way, F.lit(" "), adaptive_number(expected)))


def palette(labels: DataFrame, label: str, given: dict[str, str]) -> DataFrame:
    """(label, colour): the given colours, and for other labels one from an even circle of hues in order of the labels."""
    known = F.create_map(*[x for k, v in given.items() for x in (F.lit(k), F.lit(v))]) if given else F.create_map().cast("map<string,string>")
    kinds = labels.select(F.col(label).cast("string").alias("label")).distinct()
    n, place = F.count("*").over(Window.partitionBy()), F.row_number().over(Window.orderBy("label")) - 1  # a row a label
    hue = F.format_string("hsl(%d,65%%,50%%)", F.floor(place * 360 / n).cast("int"))
    return kinds.select("label", F.coalesce(F.try_element_at(known, F.col("label")), hue).alias("colour"))
