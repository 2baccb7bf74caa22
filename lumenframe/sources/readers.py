"""Readers for the file layouts the jobs start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Types are inferred (an extra pass) only if no schema is given."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_multiline_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV whose quoted fields hold line breaks; a quote inside a field is doubled.

    Such a file cannot be split, so keep each file at the size of one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def read_libsvm(spark: SparkSession, path: str, n_features: int | None = None) -> DataFrame:
    """Sparse ``label``/``features``; giving the width saves a pass over the files."""
    reader = spark.read.format("libsvm")
    if n_features is not None:
        reader = reader.option("numFeatures", str(n_features))
    return reader.load(path)


# The weather record layout (0-based start, end, type, divisor).
WEATHER_LAYOUT = {
    "year": (15, 19, "int", 1),
    "month": (19, 21, "int", 1),
    "day": (21, 23, "int", 1),
    "hour": (23, 25, "int", 1),
    "latitude": (28, 34, "double", 1000),
    "longitude": (34, 41, "double", 1000),
    "elevationDimension": (46, 51, "int", 1),
    "directionAngle": (60, 63, "int", 1),
    "speedRate": (65, 69, "double", 10),
    "ceilingHeightDimension": (70, 75, "int", 1),
    "distanceDimension": (78, 84, "int", 1),
    "dewPointTemperature": (93, 98, "double", 10),
    "airTemperature": (87, 92, "double", 10),
}
WEATHER_MISSING = {"airTemperature": "+9999"}


def _slice(line: Column, start: int, end: int) -> Column:
    return F.substring(line, start + 1, end - start)


def read_fixed_width(
    spark: SparkSession,
    path: str,
    layout: dict[str, tuple[int, int, str, int]] = WEATHER_LAYOUT,
    drop_if: dict[str, str] = WEATHER_MISSING,
    null_if: dict[str, str] | None = None,
) -> DataFrame:
    """Cut typed fields out of fixed positions.

    ``drop_if`` removes lines whose field holds the missing code; ``null_if`` turns
    the missing codes of other fields into nulls (off unless asked for).
    """
    line = F.col("value")
    lines = spark.read.text(path)
    for name, code in drop_if.items():
        start, end, _, _ = layout[name]
        lines = lines.where(_slice(line, start, end) != code)
    fields = []
    for name, (start, end, kind, divisor) in layout.items():
        raw = _slice(line, start, end)
        if null_if and name in null_if:
            raw = F.when(raw != null_if[name], raw)
        typed = raw.cast(kind)
        fields.append((typed / divisor if divisor != 1 else typed).alias(name))
    return lines.select(*fields)


def read_points(spark: SparkSession, path: str, names: tuple[str, ...] = ("vec_1", "vec_2")) -> DataFrame:
    """Numbers separated by any run of blanks, without a header."""
    parts = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    rows = spark.read.text(path).where(F.trim("value") != "")
    return rows.select(*[F.get(parts, F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])


def read_ragged(
    spark: SparkSession, path: str, key: str = "key", items: str = "items", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """One line = a key and then any number of comma-separated items."""
    if encoding.upper() in ("UTF-8", "UTF8"):
        rows = spark.read.text(path)
    else:
        # The text source reads UTF-8 only; a separator that cannot occur keeps each
        # line in one CSV column.
        rows = (
            spark.read.schema("value string")
            .option("encoding", encoding)
            .option("sep", "\u0001")
            .option("quote", "")
            .csv(path)
        )
    parts = F.split("value", ",")
    return rows.select(F.get(parts, F.lit(0)).alias(key), F.slice(parts, 2, F.size(parts)).alias(items))


def read_list_skipping(
    spark: SparkSession, path: str, skip: list[int], name: str = "word", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """First word of every line of a list, leaving out the given line numbers of each file.

    Lines are numbered over two passes, for files of any size: lines are counted per block
    of a file, and a line's number is its place in the block after the lines before it.
    """
    meta = F.col("_metadata")
    raw = spark.read.text(path).select(
        meta["file_path"].alias("_file"), meta["file_block_start"].alias("_block"), "value", F.monotonically_increasing_id().alias("_id")
    )
    blocks = raw.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block of a file, as many as there are tasks.
    blocks = F.broadcast(blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    lines = raw.join(blocks, ["_file", "_block"]).select((F.col("_id") - F.col("_first") + F.col("_before")).alias("line"), "value")
    # The text source keeps the bytes of a line, whatever their encoding.
    text = F.rtrim(F.decode(F.col("value").cast("binary"), encoding), F.lit("\r"))
    kept = lines.select("line", text.alias("value")).where(~F.col("line").isin(skip) & (F.trim("value") != ""))
    return kept.select(F.get(F.split("value", " "), F.lit(0)).alias(name))


def read_words(spark: SparkSession, path: str, name: str = "word") -> DataFrame:
    """One word per line, as a set."""
    return spark.read.text(path).select(F.col("value").alias(name)).where(f"{name} <> ''").distinct()


def read_array_records(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Numeric arrays per record, widened to double."""
    df = spark.read.parquet(path)
    wide = [
        F.col(f.name).cast("array<double>").alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, T.ArrayType)
        else F.col(f.name)
        for f in df.schema.fields
        if not columns or f.name in columns
    ]
    return df.select(*wide)


def _elements(html: Column, tag: str) -> Column:
    """Every element of the name, whole, in the order of the opening tags.

    Tags of the name are matched as brackets are: a closing tag ends the last one still
    open.  Elements inside one of the same name are found too, each with all it holds.  A
    closing tag too many and an opening tag that is never closed are passed over.
    """
    mark = rf"(?is)<{tag}(?:\s[^>]*)?>|</{tag}\s*>"
    pair = "struct<first:int,last:int>"
    start = F.struct(F.array().cast("array<int>").alias("open"), F.array().cast(f"array<{pair}>").alias("done"))

    def pairs(closes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            stack, done = state["open"], state["done"]
            ended = F.struct(F.element_at(stack, -1).alias("first"), i.alias("last"))
            pushed = F.struct(F.concat(stack, F.array(i)).alias("open"), done.alias("done"))
            popped = F.struct(F.slice(stack, 1, F.size(stack) - 1).alias("open"), F.concat(done, F.array(ended)).alias("done"))
            return F.when(~F.get(closes, i), pushed).when(F.size(stack) > 0, popped).otherwise(state)

        places = F.when(F.size(closes) > 0, F.sequence(F.lit(0), F.size(closes) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, start, step, lambda state: F.array_sort(state["done"]))

    def elements(cut: Column) -> Column:
        def whole(pair: Column) -> Column:
            parts = F.transform(
                F.sequence(pair["first"], pair["last"]),
                lambda i: F.concat(F.get(cut["tags"], i), F.when(i < pair["last"], F.get(cut["gaps"], i + 1)).otherwise("")),
            )
            return F.array_join(parts, "")

        return F.transform(_once(F.transform(cut["tags"], lambda t: t.startswith("</")), pairs), whole)

    return _once(F.struct(F.regexp_extract_all(html, F.lit(mark), F.lit(0)).alias("tags"), F.split(html, mark, -1).alias("gaps")), elements)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once a row; a column used within a lambda function is
    made again for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _attribute(element: Column, name: str) -> Column:
    return F.regexp_extract(element, rf'(?is)^<[^>]*?\s{name}="([^"]*)"', 1)


def _text(element: Column) -> Column:
    return F.regexp_replace(element, r"(?s)<[^>]*>", "")


def extract_elements(
    pages: DataFrame, key: str, html: str, tag: str, class_like: str | None = None, attribute: str | None = None
) -> DataFrame:
    """(key, pos, text[, attribute]) of each ``tag`` element, optionally by class regex.

    Positions follow the opening tags.  An element nested in one of the same name is an
    element of its own, and its text is part of the outer one's too.
    """
    elements = _elements(F.col(html), tag)
    if class_like is not None:
        # Filtered before they are numbered, so positions need no window.
        elements = F.filter(elements, lambda e: _attribute(e, "class").rlike(class_like))
    found = pages.select(key, F.posexplode_outer(elements).alias("pos", "_el")).where(F.col("_el").isNotNull())
    extra = [_attribute(F.col("_el"), attribute).alias(attribute)] if attribute else []
    return found.select(key, "pos", _text(F.col("_el")).alias("text"), *extra)


def paired_review_rows(
    pages: DataFrame,
    key: str = "page_id",
    html: str = "html",
    *,
    text_tag: str,
    text_class: str,
    score_tag: str,
    score_class: str,
    score_attribute: str,
) -> DataFrame:
    """Review text with the score given by its author.

    The first score of a page rates the whole place and is skipped: review i takes
    score i + 1.  A page with too few or unreadable scores gives no row at all.
    """

    def picked(tag: str, like: str) -> Column:
        return F.filter(_elements(F.col(html), tag), lambda e: _attribute(e, "class").rlike(like))

    texts = F.transform(picked(text_tag, text_class), _text)
    scores = F.transform(
        picked(score_tag, score_class),
        lambda e: F.substring(_attribute(e, score_attribute), 1, 1).try_cast("int"),
    )
    both = pages.select(key, texts.alias("_t"), scores.alias("_s")).select(
        key, "_t", F.slice("_s", 2, F.size("_t")).alias("_s")
    )
    sound = both.where(
        (F.size("_t") > 0)
        & (F.size("_s") == F.size("_t"))
        & ~F.exists("_s", lambda s: s.isNull())
    )
    rows = sound.select(key, F.posexplode(F.arrays_zip("_t", "_s")).alias("pos", "_r"))
    return rows.select(
        key, "pos", F.col("_r._t").alias("review"), F.col("_r._s").alias("real_score")
    )


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared schema; a null in a non-nullable field is an error."""
    cols = []
    for f in schema.fields:
        col = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            col = F.coalesce(col, F.raise_error(F.lit(f"null in {f.name}")).cast(f.dataType))
        cols.append(col.alias(f.name))
    return df.select(*cols)
