"""Bindings of the reference's inputs to the local test tables.

Each builder derives a reference-shaped input from the given tables with plain column
expressions, so its size grows with the tables. ``cobble.plans.oracle`` restates every
derivation in DuckDB SQL for the side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cobble.functions.streets import ALL_BOROUGH_SPELLINGS
from cobble.session import shared_scratch, spread, table

# Fixed values of the test binding (not of the reference): the six part types of the
# test tables, used to spell alias streets, and the borough field values of probe rows
# (the accepted spellings, then two invalid ones).
PART_TYPES = ("STANDARD", "MEDIUM", "PROMO", "LARGE", "ECONOMY", "SMALL")
PROBE_BOROUGHS = (*ALL_BOROUGH_SPELLINGS, "XX", " ")
ORDINAL_ENDINGS = ("th st", "st st", "nd st")


def _pick(index, values) -> F.Column:
    """values[index] for a 0-based integer column (one array lookup, not a CASE chain that
    the optimizer would copy into every predicate on the picked value)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


_WRITTEN: dict[tuple[str, str, str], str] = {}


def written_once(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """Write a derived input once per session to the shared checkpoint folder and read it
    back: the raw input stands in for a set of CSV files, and like them it is scanned in
    parallel splits (the test tables are single row groups, which Spark cannot split)."""
    return spark.read.parquet(written_path(spark, name, sf_dir, build))


def written_path(spark: SparkSession, name: str, sf_dir: str, build) -> str:
    """Folder of the once-written table ``name`` for ``sf_dir`` (written on first use)."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    path = _WRITTEN.get(key)
    if path is None:
        path = shared_scratch(spark, name)
        build().write.mode("overwrite").parquet(path)
        _WRITTEN[key] = path
    return path


def yearly_files(spark: SparkSession, sf_dir: str, years) -> list[str]:
    """A folder of raw violation rows for each year, and a last one for rows of other years or none: the
    files as they arrive."""

    def write(path: str) -> None:
        year = F.substring("issue_date", -4, 4)
        part = F.when(year.isin(*[str(y) for y in years]), year).otherwise("other")
        violation_table(spark, sf_dir).withColumn("part", part).write.partitionBy("part").parquet(path)

    path = written_files(spark, "violations_by_year", sf_dir, write)
    return [f"{path}/part={y}" for y in (*years, "other")]


VIOLATION_HEADER = ("Issue Date", "Violation County", "House Number", "Street Name")


def violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw violation rows, derived from lineitem and written once as headed CSV files (the
    reference's input form), read back by column position; the header line of every file
    is dropped by value."""
    from cobble.sources.io import read_positional_csv, write_csv

    def write(path: str) -> None:
        write_csv(violation_table(spark, sf_dir).toDF(*VIOLATION_HEADER), path, header=True)

    path = written_files(spark, "violation_csv", sf_dir, write)
    names = ["issue_date", "county", "house_number", "street_name"]
    return read_positional_csv(spark, path, names, header_first=VIOLATION_HEADER[0])


def written_files(spark: SparkSession, name: str, sf_dir: str, write) -> str:
    """Folder of files that ``write(path)`` makes once a session: the given form of some input."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _WRITTEN:
        path = shared_scratch(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def line_files(spark: SparkSession, sf_dir: str) -> str:
    """Text files of all document lines, 'doc_id <tab> line_no <tab> line', in order of (document, line)."""

    def write(path: str) -> None:
        docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
        lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        text = F.concat_ws("\t", F.col("doc_id").cast("string"), F.col("line_no").cast("string"), "line")
        lines.orderBy("doc_id", "line_no").select(text.alias("value")).write.text(path)

    return written_files(spark, "line_files", sf_dir, write)


def collection_files(spark: SparkSession, sf_dir: str, properties) -> str:
    """FeatureCollection documents of the segment features."""
    from cobble.sources.io import write_feature_collections

    return written_files(
        spark, "collections", sf_dir, lambda path: write_feature_collections(segment_features(spark, sf_dir), path, properties, "ord")
    )


def violation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw violation rows, derived from lineitem and written once as a table. Catalyst would copy the
    derivation into every predicate on a derived field; a reader of real files has none to copy."""
    return written_once(spark, "violation_table", sf_dir, lambda: derive_violation_rows(spark, sf_dir))


def derive_violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> raw violation rows: issue_date 'MM/dd/yyyy', county, house_number, street_name.

    Years are shifted by 20 (1995-2001 -> 2015-2021) so the 2015-2019 filter bites.
    """
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"))
    q = F.col("l_quantity").cast("int").cast("string")
    ln = F.col("l_linenumber").cast("string")
    n = (F.col("l_suppkey") % 25 + 1).cast("string")
    hv = (F.col("l_orderkey") + F.col("l_linenumber")) % 10
    house = (
        F.when(hv == 0, q)
        .when(hv == 1, F.concat(q, F.lit("A")))
        .when(hv == 2, F.concat(ln, F.lit("-"), q))
        .when(hv == 3, F.concat(ln, F.lit("-"), q, F.lit("B")))
        .when(hv == 4, F.concat(q, F.lit("AB")))
        .when(hv == 5, F.concat(q, F.lit("-")))
        .when(hv == 6, F.lit("A"))
        .when(hv == 7, F.concat(q, F.lit(" - "), ln))
        .when(hv == 8, (F.col("l_quantity").cast("int") * 3).cast("string"))
        .otherwise(F.lit(""))
    )
    sv = F.col("l_partkey") % 4
    street = (
        F.when(sv == 0, F.concat(F.lit("w "), n, _pick((F.col("l_suppkey") % 25 + 1) % 3, ORDINAL_ENDINGS)))
        .when(sv == 1, F.concat(F.lower(_pick(F.col("l_suppkey") % 6, PART_TYPES)), F.lit(" ave")))
        .when(sv == 2, F.concat(F.lit("W  "), n, F.lit(" ST")))
        .otherwise(F.concat(n, F.lit("rd ave")))
    )
    date = F.when(F.col("l_orderkey") % 50 == 0, F.lit("")).otherwise(
        F.concat(
            F.lpad(F.month("l_shipdate").cast("string"), 2, "0"),
            F.lit("/"),
            F.lpad(F.dayofmonth("l_shipdate").cast("string"), 2, "0"),
            F.lit("/"),
            (F.year("l_shipdate") + 20).cast("string"),
        )
    )
    return li.select(
        date.alias("issue_date"),
        _pick(F.col("l_suppkey") % len(PROBE_BOROUGHS), PROBE_BOROUGHS).alias("county"),
        house.alias("house_number"),
        street.alias("street_name"),
    )


def segment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> street segment features (physicalid, st_label, full_stree, borocode, ranges, ord)."""
    p = table(spark, sf_dir, "part")
    two = F.col("p_partkey") % 4 == 0
    size = F.col("p_size")

    def s(c):
        return c.cast("string")

    r_high = F.when(two, F.concat(F.lit("7-"), s(size % 8 * 2 + 40))).otherwise(s(size % 10 * 2 + 30))
    return p.select(
        F.col("p_partkey").alias("physicalid"),
        F.concat(F.lit("W "), F.regexp_extract("p_brand", "#([0-9]+)", 1), F.lit(" ST")).alias("st_label"),
        F.when(F.col("p_partkey") % 53 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat("p_type", F.lit(" AVE")))
        .alias("full_stree"),
        s(F.col("p_partkey") % 5 + 1).alias("borocode"),
        F.when(two, F.concat(F.lit("1-"), s(size % 10))).otherwise(s(size % 20)).alias("l_low_hn"),
        F.when(two, F.concat(F.lit("7-"), s(size % 10 + 40))).otherwise(s(size % 20 + 25)).alias("l_high_hn"),
        F.when(two, F.concat(F.lit("1-"), s(size % 8 * 2))).otherwise(s(size % 10 * 2)).alias("r_low_hn"),
        F.when(F.col("p_partkey") % 97 == 0, F.concat(r_high, F.lit("A"))).otherwise(r_high).alias("r_high_hn"),
        F.col("p_partkey").alias("ord"),
    )


def segment_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster of segment ids: every part key, and every hundredth one a second time."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pid"))
    return p.unionByName(p.filter(F.col("pid") % 100 == 0))
