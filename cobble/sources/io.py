"""Sources and sinks: text, CSV (headed, positional, multi-line), GeoJSON features, id
lists, file streams; CSV / text / parquet writers.

Readers take explicit schemas (no inference pass over the data). Formats that can't be cut at plain
separators (multi-line CSV, one JSON document per file) go through ``cobble.sources.splits``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cobble.sources.splits import csv_records, feature_texts


# ----------------------------------------------------------------------------- readers


def read_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line (``value``), over a path, a glob or several paths (IO1, U4)."""
    return spark.read.text([paths] if isinstance(paths, str) else list(paths))


def read_csv_records(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, header: bool = True
) -> DataFrame:
    """Headed CSV as named records: the header line of every file is skipped, quoted
    commas stay inside their field (IO2, IO5, IO6)."""
    return spark.read.csv(paths, schema=schema, header=header, mode="PERMISSIVE", quote='"', escape='"')


def read_multiline_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Headed CSV whose quoted fields hold newlines (IO3), as a reader of whole files gives it, but read by
    as many tasks as the files have splits: ``cobble.sources.splits`` finds out which line ends lie
    inside quotes."""
    records = csv_records(spark, paths, header=True)
    kind = schema if isinstance(schema, str) else schema.toDDL()
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return records.select(F.from_csv("value", kind, options).alias("r")).select("r.*")


def read_positional_csv(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], header_first: str | None = None) -> DataFrame:
    """CSV read by column position, all strings (IO4). A real CSV parser, so a quoted comma
    does not shift the later columns (a plain ``split(',')`` would). Rows whose first field
    equals ``header_first`` are dropped wherever they occur (IO5)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # Fields stay text as written: an empty field is '' (not NULL), spaces are kept.
    df = spark.read.csv(paths, schema=schema, header=False, quote='"', escape='"', nullValue="\u0000")
    if header_first is not None:
        df = df.filter(F.col(names[0]).isNull() | (F.col(names[0]) != F.lit(header_first)))
    return df


def drop_header_lines(df: DataFrame, prefix: str, col: str = "value") -> DataFrame:
    """Raw text: drop every line starting with the header text (IO5)."""
    return df.filter(~F.col(col).startswith(prefix))


def read_geojson_features(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: T.StructType,
    collection: bool = False,
    ordinal: str | None = None,
) -> DataFrame:
    """GeoJSON features -> one row per feature with its properties as columns; geometry is
    dropped (IO7).

    ``collection=False`` reads one Feature per line (newline-delimited). ``collection=True`` reads
    FeatureCollection documents, which are cut into features by as many tasks as they have splits.
    ``ordinal`` names a column that keeps the source order of the features: a struct (file path,
    position in file), since Spark packs file splits into partitions by size, not by path.
    """
    feature = T.StructType([T.StructField("type", T.StringType()), T.StructField("properties", properties)])
    if collection:
        texts = feature_texts(spark, paths)
        f = texts.select(F.struct("file", "pos").alias("_order"), F.from_json("value", feature).alias("f"))
        return f.select("f.properties.*", *([F.col("_order").alias(ordinal)] if ordinal else []))
    df = spark.read.json(paths, schema=feature)
    # Within one file the row id follows the offset; the path orders the files.
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"))
    cols = ["properties.*"] + ([order.alias(ordinal)] if ordinal else [])
    return df.select(*cols)


def read_id_list(spark: SparkSession, paths: str | Sequence[str], name: str = "pid") -> DataFrame:
    """Comma-separated ids on one or more lines -> one BIGINT row per id, repeats kept (IO8).

    The comma is the record separator, so a list that is one long line is cut into splits
    like any text; line ends are left inside a record and split there."""
    return (
        spark.read.text(paths, lineSep=",")
        .select(F.explode(F.split("value", r"[\r\n]+", -1)).alias("v"))
        .filter(F.trim("v") != "")
        .select(F.trim("v").cast("bigint").alias(name))
    )


def literal(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A small literal dataset (IO9)."""
    return spark.createDataFrame(list(rows), schema=schema)


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A file stream: each new file in ``path`` is read once, in bounded micro-batches (IO10)."""
    r = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(path)


# ----------------------------------------------------------------------------- writers


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """CSV with fields quoted only when needed (a comma, quote or newline inside); inner
    quotes are escaped by doubling (IO11, IO12, IO13). Leading and trailing spaces are kept
    (Spark's writer would trim them by default)."""
    df.write.mode(mode).csv(
        path,
        header=header,
        quote='"',
        escape='"',
        quoteAll=False,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_lines(
    df: DataFrame,
    path: str,
    cols: Sequence[str | Column],
    sep: str = ", ",
    mode: str = "overwrite",
    folders: str | None = None,
) -> None:
    """One text line per row, fields joined by ``sep``, no header (IO14); a folder for each
    value of the column ``folders``, if named."""
    fields = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    lines = df.select(F.concat_ws(sep, *fields).alias("value"), *([folders] if folders else []))
    writer = lines.write.mode(mode)
    (writer.partitionBy(folders) if folders else writer).text(path)


def write_id_list(df: DataFrame, path: str, col: str = "pid", per_line: int = 1000, mode: str = "overwrite") -> None:
    """Ids as comma-separated lines of at most ``per_line`` ids each, in input order: no line
    (and no task) has to hold the whole list, even when one id repeats very often. A line
    gathers consecutive rows of one input partition (``monotonically_increasing_id`` counts
    rows within a partition, from a multiple of 2**33)."""
    row = F.monotonically_increasing_id()
    numbered = df.select(F.col(col).cast("string").alias("_v"), row.alias("_r"))
    # Partitions start at multiples of 2**33: the line number is counted within one.
    chunk = F.struct(F.shiftright("_r", 33), F.expr(f"(_r & {2**33 - 1}L) div {int(per_line)}L"))
    lines = numbered.groupBy(chunk.alias("_c")).agg(F.array_sort(F.collect_list(F.struct("_r", "_v"))).alias("_ids"))
    lines.select(F.array_join(F.transform("_ids", lambda x: x["_v"]), ",").alias("value")).write.mode(mode).text(path)


def write_feature_lines(df: DataFrame, path: str, properties: Sequence[str], mode: str = "overwrite") -> None:
    """Rows -> newline-delimited GeoJSON Features (no geometry) (IO15 prepare-once form)."""
    feat = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"))
    df.select(F.to_json(feat).alias("value")).write.mode(mode).text(path)


#: Features in one FeatureCollection document.
FEATURES_PER_DOCUMENT = 5000


def write_feature_collections(
    df: DataFrame, path: str, properties: Sequence[str], order: str, mode: str = "overwrite"
) -> None:
    """Rows -> FeatureCollection documents of at most ``FEATURES_PER_DOCUMENT`` features, one
    document a file (IO7)."""
    feat = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"))
    row = F.monotonically_increasing_id()
    doc = F.concat(F.shiftright("_r", 33), F.lit("-"), F.expr(f"(_r & {2**33 - 1}L) div {FEATURES_PER_DOCUMENT}L"))
    docs = df.select(row.alias("_r"), feat.alias("f"), F.col(order).alias("o")).groupBy(doc.alias("document"))
    docs = docs.agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "f"))), lambda x: x["f"]).alias("features"))
    text = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"))
    docs.select("document", text.alias("value")).write.mode(mode).partitionBy("document").text(path)


def split_feature_collections(spark: SparkSession, paths: str | Sequence[str], out: str, mode: str = "overwrite") -> None:
    """FeatureCollection documents -> Feature lines, so that every later read can be cut (IO7, IO15).
    Properties are carried as written, whatever their names; geometry stays too. A line end inside a
    feature can only be white space between its parts, and becomes a blank."""
    features = feature_texts(spark, paths).select(F.regexp_replace("value", r"[\r\n]+", " ").alias("value"))
    features.write.mode(mode).text(out)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Prepared lookup / intermediate table as parquet (IO15)."""
    df.write.mode(mode).parquet(path)
