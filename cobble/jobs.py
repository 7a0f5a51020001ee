"""Runnable jobs over files, the way the original scripts were run:

    spark-submit cobble/jobs.py violations <violations csv glob> <segments geojson> <ids file> <out>
    spark-submit cobble/jobs.py complaints <complaints csv> <out> [--lowercase]
    spark-submit cobble/jobs.py revenue <sales csv> <out>
    spark-submit cobble/jobs.py schools <sat csv> <school directory csv> <out>
    spark-submit cobble/jobs.py words <text glob> <out> [--first-lines N]
    spark-submit cobble/jobs.py keywords <text glob> <out>
    spark-submit cobble/jobs.py bikes <trips csv> <docking events csv> <out>

Each job reads whole inputs, runs the library operators and writes its result folder(s).
"""

from __future__ import annotations

import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cobble.functions import text as X
from cobble.operators import aggregates as A
from cobble.operators import ordered as O
from cobble.operators import violations as V
from cobble.session import ensure_checkpoint_dir, shared_scratch, spread
from cobble.sources import io

# Positions of the fields the violations job reads (0-based) in the city's parking
# violation files: summons number, issue date, violation county, house number, street.
VIOLATION_FIELDS = {"summons": 0, "issue_date": 4, "county": 21, "house_number": 23, "street_name": 24}
SEGMENT_PROPS = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("physicalid", "st_label", "full_stree", "borocode", "l_low_hn", "l_high_hn", "r_low_hn", "r_high_hn")
    ]
)


def _input_order():
    """Input order of rows: (file path, row id). Spark packs file splits into partitions by
    size, so the row id alone does not follow the path; within one file it follows the
    offset."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"))


def violations(spark: SparkSession, violations_glob: str, segments_path: str, ids_path: str, out: str,
               collection: bool = True) -> DataFrame:
    """Violations -> per segment id: yearly counts 2015-2019 and slope, every roster id, in
    id order, as 'id, y2015, ..., y2019, slope' lines."""
    names = [f"c{i}" for i in range(max(VIOLATION_FIELDS.values()) + 1)]
    raw = io.read_positional_csv(spark, violations_glob, names, header_first="Summons Number")
    raw = raw.select(*[F.col(f"c{i}").alias(n) for n, i in VIOLATION_FIELDS.items()])
    probes = V.prepare_violations(raw, "issue_date", "county", "house_number", "street_name")
    feats = io.read_geojson_features(spark, segments_path, SEGMENT_PROPS, collection=collection, ordinal="ord")
    segments, aliases = V.prepare_segments(feats)
    roster = io.read_id_list(spark, ids_path, "pid")
    report = V.violations_report(probes, segments, aliases, roster)
    V.report_lines(report).write.mode("overwrite").text(out)
    return report


def complaints(spark: SparkSession, path: str, out: str, lowercase: bool = False) -> DataFrame:
    """Complaints CSV (quoted fields may hold newlines) -> product, year, complaints,
    companies, top company's share in whole percent, as CSV."""
    df = spread(spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"'), splits=False)
    rep = A.complaints_report(df, "Product", "Date sent to company", "Company", lowercase_product=lowercase)
    io.write_csv(rep.orderBy("product", "year"), out)
    return rep


def revenue(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Sales CSV -> Product ID, Customer Count, Total Revenue (exact distinct customers), products
    in order of first appearance in the input."""
    from cobble.plans.queries import write_revenue_report

    schema = "`Customer ID` STRING, `Transaction ID` STRING, `Date` STRING, `Product ID` STRING, `Item Cost` STRING"
    sales = io.read_csv_records(spark, path, schema).withColumn("_row", _input_order())
    rep = A.distinct_and_total(
        sales.withColumnRenamed("Product ID", "product"), "product", "Customer ID", "Item Cost", first_seen="_row"
    )
    write_revenue_report(rep.orderBy("first_seen"), out)
    return rep


def schools(spark: SparkSession, sat_path: str, schools_path: str, out: str, min_students: int = 500) -> DataFrame:
    """Weighted mean SAT math score of large schools per borough, truncated."""
    sat = io.read_positional_csv(spark, sat_path, ["dbn", "name", "takers", "reading", "math", "writing"], header_first="DBN")
    sat = sat.filter(F.col("takers") != "s").select(
        "dbn", F.col("takers").try_cast("bigint").alias("takers"), F.col("math").try_cast("bigint").alias("score")
    )
    # Rows of exactly 58 fields: the last one is there, and there is none after it.
    names = [f"c{i}" for i in range(59)]
    sch = io.read_positional_csv(spark, schools_path, names, header_first="dbn")
    exact = F.col("c57").isNotNull() & F.col("c58").isNull()
    big = sch.filter(F.col("c17").rlike(r"\A[0-9]+\z") & exact).filter(
        F.col("c17").cast("bigint") > min_students
    ).select(F.col("c0").alias("dbn"), F.col("c2").alias("boro"))
    rep = A.weighted_mean_truncated(big.join(sat, "dbn"), "boro", "score", "takers")
    io.write_csv(rep, out)
    return rep


def words(spark: SparkSession, path: str, out: str, first_lines: int | None = None) -> DataFrame:
    """Lower-cased [\\w']+ word counts of text files, the ten most frequent, and the most used
    word (ties to the greatest word). ``first_lines`` counts only the first n input lines
    (files in path order): lines are numbered by counting them a split, and no further file is read."""
    lines = io.read_text(spark, path) if first_lines is None else O.first_text_lines(spark, path, int(first_lines))
    counts = A.token_counts(spread(lines), F.transform(X.word_tokens("value", True), lambda w: F.lower(w)))
    # Counted once: the other two results are taken from the written counts.
    io.write_csv(counts, os.path.join(out, "counts"))
    counts = spark.read.csv(
        os.path.join(out, "counts"), schema=counts.schema, quote='"', escape='"', nullValue="\0", emptyValue=""
    )
    io.write_csv(O.top_k(counts, 10, F.desc("n"), F.asc("word")), os.path.join(out, "top10"))
    io.write_csv(A.most_frequent(counts, "word", "n"), os.path.join(out, "most_used"))
    return counts


def keywords(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Capitalised phrases of each text file: (file, sentence, pos, keyword), where ``sentence``
    rises with the place in the file. The full stop is the record separator, so one large
    file is cut like any text, and no phrase crosses a sentence anyway."""
    sentences = spark.read.text(path, lineSep=".").select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("sentence"), "value"
    )
    kw = spread(sentences).select("file", "sentence", F.posexplode(X.keywords("value")).alias("pos", "keyword"))
    io.write_csv(kw, out)
    return kw


def bikes(spark: SparkSession, trips_path: str, docking_path: str, out: str) -> dict[str, DataFrame]:
    """Bike-share statistics: trips per station and per station pair, top subscriber
    pickup station per gender, rides per hour, first ride of each day, most riders out at
    once (from trips and from docking events)."""
    trips = io.read_csv_records(
        spark,
        trips_path,
        "tripduration STRING, starttime TIMESTAMP, stoptime TIMESTAMP, start_station_id STRING, "
        "start_station_name STRING, s_lat STRING, s_lon STRING, end_station_id STRING, end_station_name STRING, "
        "e_lat STRING, e_lon STRING, bikeid STRING, usertype STRING, birth_year STRING, gender INT",
    ).withColumn("_row", _input_order())
    # Parsed once; each result then reads only its own columns.
    parsed = shared_scratch(spark, "trips")
    io.write_table(trips, parsed)
    trips = spark.read.parquet(parsed)
    labels = F.element_at(F.array(F.lit("Unknown"), F.lit("Male"), F.lit("Female")), F.col("gender") + 1)
    pick = trips.filter(F.col("usertype") == "Subscriber").groupBy(labels.alias("gender"), "start_station_name").agg(
        F.count(F.lit(1)).alias("trips")
    )
    dock = io.read_csv_records(spark, docking_path, "time TIMESTAMP, bikeid STRING, station_id STRING, event STRING")
    dock = dock.withColumn("_row", _input_order())
    delta = F.when(F.col("event") == "undock", 1).when(F.col("event") == "dock", -1).otherwise(0)
    res = {
        "station_trips": A.endpoint_counts(trips, "start_station_name", "end_station_name"),
        "station_pairs": A.pair_counts(trips, "start_station_name", "end_station_name"),
        "top_station_by_gender": A.best_per_group(pick, "gender", "start_station_name", "trips"),
        "hour_histogram": trips.groupBy(F.hour("starttime").alias("hour")).agg(F.count(F.lit(1)).alias("n")),
        "first_ride_of_day": O.first_per_group(trips, F.to_date("starttime"), ["starttime", "_row"], "day").drop("_row"),
        "max_riders_from_trips": O.max_concurrency(trips, "starttime", "stoptime"),
        "max_riders_from_docks": O.max_running_level(dock, ["time", "_row"], delta, F.col("event") == "undock"),
    }
    for name, df in res.items():
        io.write_csv(df, os.path.join(out, name))
    return res


def main(argv: list[str]) -> None:
    spark = SparkSession.builder.appName(f"cobble-{argv[1]}").getOrCreate()
    ensure_checkpoint_dir(spark)
    job, args = argv[1], argv[2:]
    if job == "complaints":
        complaints(spark, args[0], args[1], lowercase="--lowercase" in args)
    elif job == "words":
        n = int(args[args.index("--first-lines") + 1]) if "--first-lines" in args else None
        words(spark, args[0], args[1], first_lines=n)
    else:
        {"violations": violations, "revenue": revenue, "schools": schools, "words": words,
         "keywords": keywords, "bikes": bikes}[job](spark, *args)


if __name__ == "__main__":
    main(sys.argv)
