"""Registered queries: each binds an operator to the test tables and returns a DataFrame.

Every query reads whole tables (or data Spark derives from them); nothing is capped,
sampled or subset. Column names equal those of the matching oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cobble.operators import violations as V
from cobble.plans import testdata as TD
from cobble.session import spread, table

YEARS = (2015, 2016, 2017, 2018, 2019)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = TD.violation_table(spark, sf_dir)
    return V.prepare_violations(raw, "issue_date", "county", "house_number", "street_name", YEARS)


def _violations_report(spark: SparkSession, sf_dir: str, ordered: bool = True) -> DataFrame:
    segments, aliases = V.prepare_segments(TD.segment_features(spark, sf_dir))
    roster = TD.segment_roster(spark, sf_dir)
    return V.violations_report(_violations(spark, sf_dir), segments, aliases, roster, YEARS, ordered)


@register("violations_by_segment")
def violations_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: roster ids with yearly violation counts and slope."""
    return _violations_report(spark, sf_dir)


@register("resolve_segments")
def resolve_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct violation addresses with the segment each resolves to."""
    from cobble.operators.joins import first_match_segment, street_index

    segments, aliases = V.prepare_segments(TD.segment_features(spark, sf_dir))
    addr = V.address_counts(_violations(spark, sf_dir), YEARS)
    m = first_match_segment(addr, street_index(segments, aliases), V.ADDRESS_KEYS)
    total = sum((F.col(f"y{y}") for y in YEARS[1:]), F.col(f"y{YEARS[0]}"))
    return m.select("street", "borough", "house", "pid", total.alias("violations"))


#: Buckets of the roster and the counts.
BUCKETS = 16


@register("violations_incremental")
def violations_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship from violations that arrive year by year: each year's files are added to the counts, only
    new addresses are resolved, and the bucketed roster is joined without an exchange (U4, G17-G19, J3, IO15)."""
    from cobble.operators.incremental import ViolationStore, write_bucketed
    from cobble.operators.joins import street_index
    from cobble.session import shared_scratch

    segments, aliases = V.prepare_segments(TD.segment_features(spark, sf_dir))
    index = street_index(segments, aliases)
    store = ViolationStore(shared_scratch(spark, "violation_store"), YEARS)
    for batch, path in enumerate(TD.yearly_files(spark, sf_dir, YEARS)):
        raw = spark.read.schema("issue_date STRING, county STRING, house_number STRING, street_name STRING").parquet(path)
        prepared = V.prepare_violations(raw, "issue_date", "county", "house_number", "street_name", YEARS)
        store.add(prepared, index, batch)
    roster = write_bucketed(TD.segment_roster(spark, sf_dir).select(F.col("pid").cast("bigint").alias("pid")), "pid", BUCKETS)
    return store.report(roster, BUCKETS)


# --------------------------------------------------------------------------- reports


@register("complaints_report")
def complaints_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (product, year): complaints, companies, top company's share.

    product = part brand (one brand blanked to NULL to exercise the null filter), year of
    the ship date, company = supplier."""
    from cobble.operators.aggregates import complaints_report as report

    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#7")).alias("p_brand"))
    rows = li.join(p, li.l_partkey == p.p_partkey).select(
        "p_brand", F.col("l_shipdate").cast("string").alias("date_sent"), "l_suppkey"
    )
    return report(rows, "p_brand", "date_sent", "l_suppkey")


def _product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cobble.operators.aggregates import distinct_and_total

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_partkey").alias("product"), "o_custkey", "l_extendedprice"
    )
    return distinct_and_total(rows, "product", "o_custkey", "l_extendedprice")


@register("product_revenue")
def product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per product: exact distinct customers and revenue."""
    return _product_revenue(spark, sf_dir).withColumn("revenue", F.col("revenue").cast("double"))


@register("customer_runs")
def customer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type: runs of consecutive equal users in time order (W1), next to the
    exact distinct users and value total (G6)."""
    from cobble.operators.aggregates import distinct_and_total
    from cobble.operators.ordered import change_runs

    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    runs = change_runs(ev, "event_type", "user_id", ["ts", "event_id"])
    exact = distinct_and_total(ev, "event_type", "user_id", "value")
    exact = exact.select("event_type", F.col("customers").alias("users"), F.col("revenue").cast("double"))
    return runs.join(exact, "event_type")


# --------------------------------------------------------------------------- trips


def _trip_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> (start station, end station): supplier nation and customer nation names,
    with the order priority and a 0/1/2 rider code for the filtered top-k query."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ns, nc = n.alias("ns"), n.alias("nc")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == c.c_custkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(ns, F.col("s_nationkey") == F.col("ns.n_nationkey"))
        .join(nc, F.col("c_nationkey") == F.col("nc.n_nationkey"))
        .select(
            F.col("ns.n_name").alias("start_station"),
            F.col("nc.n_name").alias("end_station"),
            F.col("o_orderpriority").alias("usertype"),
            (F.col("c_custkey") % 3).cast("int").alias("gender"),
        )
    )


@register("station_trips")
def station_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips touching each station, both endpoints counted."""
    from cobble.operators.aggregates import endpoint_counts

    return endpoint_counts(_trip_endpoints(spark, sf_dir), "start_station", "end_station")


@register("busy_stations")
def busy_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations with more trips than the average station, whatever the size (F10, HAVING)."""
    from cobble.operators.aggregates import endpoint_counts, having_more_than

    counts = endpoint_counts(_trip_endpoints(spark, sf_dir), "start_station", "end_station")
    return having_more_than(counts, "trips", counts.agg(F.avg("trips")).scalar())


@register("station_pairs")
def station_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per unordered station pair."""
    from cobble.operators.aggregates import pair_counts

    return pair_counts(_trip_endpoints(spark, sf_dir), "start_station", "end_station")


# Fixed values that must equal the reference's: labels of rider codes 0, 1, 2.
GENDER_LABELS = ("Unknown", "Male", "Female")


@register("top_station_by_group")
def top_station_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per rider label, the start station with most pickups among one rider type."""
    from cobble.operators.aggregates import best_per_group

    t = _trip_endpoints(spark, sf_dir).filter(F.col("usertype") == F.lit("1-URGENT"))
    label = F.element_at(F.array(*[F.lit(x) for x in GENDER_LABELS]), F.col("gender") + 1)
    counts = t.groupBy(label.alias("gender"), "start_station").agg(F.count(F.lit(1)).alias("trips"))
    return best_per_group(counts, "gender", "start_station", "trips")


# --------------------------------------------------------------------------- words


def _doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


@register("word_count_spaces")
def word_count_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts over text lines split on single spaces, case kept."""
    from cobble.functions.text import space_tokens
    from cobble.operators.aggregates import token_counts

    return token_counts(_doc_lines(spark, sf_dir), space_tokens("line"))


def _lower_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cobble.functions.text import word_tokens
    from cobble.operators.aggregates import token_counts

    d = spread(table(spark, sf_dir, "documents").select("text"))
    return token_counts(d, F.transform(word_tokens("text", with_apostrophe=True), lambda w: F.lower(w)))


@register("word_count_lower")
def word_count_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased [\\w']+ word counts."""
    return _lower_word_counts(spark, sf_dir)


@register("top_words")
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten most frequent space-separated words, ties by word (K2)."""
    from cobble.operators.ordered import top_k

    return top_k(word_count_spaces(spark, sf_dir), 10, F.desc("n"), F.asc("word"))


@register("top3_words")
def top3_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three most frequent lower-cased words (K3)."""
    from cobble.operators.ordered import top_k

    return top_k(_lower_word_counts(spark, sf_dir), 3, F.desc("n"), F.asc("word"))


@register("most_used_word")
def most_used_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """max((count, word)) over lower-cased words: ties go to the greatest word."""
    from cobble.operators.aggregates import most_frequent

    return most_frequent(_lower_word_counts(spark, sf_dir), "word", "n")


@register("keywords")
def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitalised phrases per document, in text order."""
    from cobble.functions.text import keywords as kw

    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.posexplode(kw("text")).alias("pos", "keyword"))


# --------------------------------------------------------------------------- events in time


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("hour_histogram")
def hour_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour of day, only hours present."""
    ev = table(spark, sf_dir, "events").select("ts")
    return ev.groupBy(F.hour("ts").cast("int").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@register("first_event_of_day")
def first_event_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole earliest event of each day."""
    from cobble.operators.ordered import first_per_group

    ev = table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    day = F.date_format("ts", "yyyy-MM-dd")
    return first_per_group(ev, day, ["ts", "event_id"], "day")


@register("max_concurrent_events")
def max_concurrent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest level of click (+1) minus purchase (-1), measured at clicks."""
    from cobble.operators.ordered import max_running_level

    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    delta = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", -1).otherwise(0)
    return max_running_level(ev, ["ts", "event_id"], delta, F.col("event_type") == "click")


@register("max_concurrent_trips")
def max_concurrent_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most line items 'in transit' at once: [order date, ship date) intervals."""
    from cobble.operators.ordered import max_concurrency

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    t = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.least("o_orderdate", "l_shipdate").alias("start"),
        F.greatest("o_orderdate", "l_shipdate").alias("stop"),
    )
    return max_concurrency(t, "start", "stop")


# --------------------------------------------------------------------------- status lines


# Fixed values of the test binding: order status -> service status text.
STATUS_TEXT = {"F": "Good Service", "O": "Delays", "P": "Planned Work"}


def _status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 'n,m,... : status' line per order: every line number, repeats kept, ascending."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("nums"))
    status = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in STATUS_TEXT.items()])
    return lines.join(o, lines.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey"),
        F.concat(F.array_join(F.transform("nums", lambda x: x.cast("string")), ","), F.lit(" : "), status).alias("status_line"),
    )


@register("delayed_lines")
def delayed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every 'Delays' update, one row each."""
    from cobble.functions.text import status_line_parts

    s = _status_lines(spark, sf_dir).filter(F.col("status_line").contains("Delays"))
    names, _ = status_line_parts("status_line")
    return s.select("o_orderkey", F.posexplode(names).alias("pos", "line"))


@register("delayed_line_count")
def delayed_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of delayed lines."""
    return delayed_lines(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@register("status_lines")
def status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each combined update expanded to one 'line : status' update per line."""
    from cobble.functions.text import status_line_parts

    s = _status_lines(spark, sf_dir)
    names, status = status_line_parts("status_line")
    return s.select("o_orderkey", status.alias("_st"), F.posexplode(names).alias("pos", "line")).select(
        "o_orderkey", "pos", F.concat("line", F.lit(" : "), "_st").alias("update")
    )


# --------------------------------------------------------------------------- weighted mean


@register("weighted_score")
def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per segment, the taker-weighted mean score of large accounts, truncated.

    schools = customers (size = account balance, structural check: digits only, kept when > 500);
    scores = orders (takers suppressed as 's' for low priority)."""
    from cobble.operators.aggregates import weighted_mean_truncated

    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("dbn"), F.col("c_mktsegment").alias("boro"),
        F.col("c_acctbal").cast("int").cast("string").alias("total_students"),
    )
    schools = c.filter(F.col("total_students").rlike(r"\A[0-9]+\z")).filter(
        F.col("total_students").cast("bigint") > 500
    ).select("dbn", "boro")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("dbn"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("s"))
        .otherwise((F.col("o_orderkey") % 97 + 1).cast("string"))
        .alias("takers"),
        ((F.col("o_totalprice") / 1000).cast("bigint") % 800).alias("score"),
    )
    sat = o.filter(F.col("takers") != "s").select("dbn", F.col("takers").cast("bigint").alias("takers"), "score")
    joined = schools.join(sat, "dbn").drop("dbn")
    return weighted_mean_truncated(joined, "boro", "score", "takers")


# --------------------------------------------------------------------------- scalar audits


@register("numeric_audit")
def numeric_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per (source, Number / Not a Number) over several string sources."""
    from cobble.functions.text import natural_number_label

    c = table(spark, sf_dir, "customer").select(
        F.lit("c_name_suffix").alias("source"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("v")
    )
    p = table(spark, sf_dir, "part").select(
        F.lit("p_name_token").alias("source"), F.explode(F.split("p_name", " ", -1)).alias("v")
    )
    o = table(spark, sf_dir, "orders").select(
        F.lit("priority_head").alias("source"), F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("v")
    )
    li = table(spark, sf_dir, "lineitem").select(
        F.lit("quantity_text").alias("source"), F.col("l_quantity").cast("string").alias("v")
    )
    allv = c.unionByName(p).unionByName(o).unionByName(li)
    return allv.groupBy("source", natural_number_label("v").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("words_not_in")
def words_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation turn: its words absent from the previous turn, all of them where there
    is none (A5, J6, U2).

    The previous turn is found by an equi-join on (conv_id, turn - 1), not a window, so a
    very long conversation is not gathered into one task."""
    from cobble.functions.text import words_not_in as wni

    cv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    prev = cv.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prev_text"))
    j = cv.join(prev, ["conv_id", "turn"], "left").withColumn("prev_text", F.coalesce("prev_text", F.lit("")))
    new = wni("text", "prev_text")
    return j.select("conv_id", "turn", F.array_join(new, " ").alias("new_words"), F.size(new).alias("n_new"))


@register("distinct_chars")
def distinct_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct characters of each part name, and distinct words of it."""
    from cobble.functions.text import distinct_chars as dc
    from cobble.functions.text import distinct_count

    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.select(
        "p_partkey", dc("p_name").alias("n_chars"), distinct_count(F.split("p_name", " ", -1)).alias("n_words")
    )


# Fixed values of the test binding: ordinal suffixes attached to part sizes.
SIZE_SUFFIXES = ("TH", "st", "ND", "RD")


def _street_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    sfx = F.coalesce(*[F.when(F.col("p_size") % 4 == i, F.lit(s)) for i, s in enumerate(SIZE_SUFFIXES)])
    raw = F.concat(F.col("p_size").cast("string"), sfx, F.lit("  "), F.col("p_name"), F.lit(" 1st"))
    return p.select("p_partkey", raw.alias("raw"))


@register("normalise_street")
def normalise_street(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street keys of invented street texts."""
    from cobble.functions.streets import street_key

    return _street_texts(spark, sf_dir).select("p_partkey", "raw", street_key("raw").alias("street"))


@register("house_parts")
def house_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed house numbers and side of every distinct probe house text."""
    from cobble.functions.streets import house_parity
    from cobble.functions.streets import house_parts as hp

    h = TD.violation_table(spark, sf_dir).select(F.col("house_number").alias("house")).distinct()
    parts = hp("house")
    return h.select(
        "house",
        F.array_join(F.transform(parts, lambda x: x.cast("string")), ",").alias("parts"),
        house_parity(parts).cast("int").alias("parity"),
    )


# --------------------------------------------------------------------------- yearly trend


TREND_YEARS = (1995, 1996, 1997, 1998, 1999)


def _yearly_trend(spark: SparkSession, sf_dir: str, ordered: bool) -> DataFrame:
    from cobble.operators.aggregates import with_trend, yearly_counts
    from cobble.operators.joins import roster_outer_join

    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pid"), F.year("o_orderdate").alias("year"))
    o = o.filter(F.col("year").isin(*TREND_YEARS))
    per = with_trend(yearly_counts(o, "pid", "year", TREND_YEARS), TREND_YEARS)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pid"))
    # Negative ids stand for roster entries that no order can name: keys are 0 or more.
    roster = c.unionByName(c.filter(F.col("pid") % 10 == 0).select((-F.col("pid") - 1).alias("pid")))
    ycols = [f"y{y}" for y in TREND_YEARS]
    return roster_outer_join(roster, per, "pid", [*ycols, "slope"], ordered)


@register("yearly_trend")
def yearly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers x order year: yearly counts, slope, full roster with zeros."""
    return _yearly_trend(spark, sf_dir, ordered=True)


@register("reconcile_total")
def reconcile_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of every yearly count of the flagship report."""
    from cobble.operators.aggregates import sum_of_years

    # The total does not depend on row order.
    return sum_of_years(_violations_report(spark, sf_dir, ordered=False), YEARS)


# --------------------------------------------------------------------------- sources and sinks


@register("csv_roundtrip")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows with commas, quotes and newlines inside fields, written as CSV to the shared
    folder and read back as multi-line quoted CSV (IO2, IO3, IO11, IO12, IO13, F19)."""
    from cobble.session import shared_scratch
    from cobble.sources.io import read_multiline_csv, write_csv

    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Part ID"),
        F.concat("p_name", F.lit(', "'), "p_type", F.lit('"\n'), "p_brand").alias("Description"),
        F.format_number("p_retailprice", 2).alias("Price"),
    )
    path = shared_scratch(spark, "csv_roundtrip")
    write_csv(p, path, header=True)
    back = read_multiline_csv(spark, path, "`Part ID` STRING, Description STRING, Price STRING")
    return back.select(
        F.col("Part ID").cast("bigint").alias("p_partkey"),
        F.col("Description").alias("description"),
        F.regexp_replace("Price", ",", "").cast("decimal(18,2)").cast("double").alias("price"),
    )


@register("text_roundtrip")
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly-trend lines written as ', '-joined text into two folders, read back through one
    glob, split and parsed (IO1, IO14, U4, S4)."""
    from cobble.session import shared_scratch
    from cobble.sources.io import read_text, write_lines

    rep = _yearly_trend(spark, sf_dir, ordered=False)
    ycols = [f"y{y}" for y in TREND_YEARS]
    base = shared_scratch(spark, "text_roundtrip")
    # Every row goes to one of the folders, in one pass: even ids to one, all others to the other.
    even = F.coalesce(F.col("pid") % 2 == 0, F.lit(False))
    write_lines(rep.withColumn("part", F.when(even, "even").otherwise("odd")), base, ["pid", *ycols, "slope"], folders="part")
    lines = read_text(spark, f"{base}/part=*")
    f = F.split("value", ", ", -1)
    return lines.select(
        F.element_at(f, 1).cast("bigint").alias("pid"),
        *[F.element_at(f, i + 2).cast("bigint").alias(c) for i, c in enumerate(ycols)],
        F.element_at(f, len(ycols) + 2).cast("double").alias("slope"),
    )


@register("id_list")
def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer ids written as comma-separated lines and read back as rows (IO8)."""
    from cobble.session import shared_scratch
    from cobble.sources.io import read_id_list, write_id_list

    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pid"))
    path = shared_scratch(spark, "id_list")
    write_id_list(c.unionByName(c.filter(F.col("pid") % 7 == 0)), path)
    return read_id_list(spark, path)


FEATURE_PROPS = [
    "physicalid", "st_label", "full_stree", "borocode", "l_low_hn", "l_high_hn", "r_low_hn", "r_high_hn", "ord"
]


@register("feature_explode")
def feature_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment features written as GeoJSON Feature lines, read back to property columns
    (IO7, IO15)."""
    from pyspark.sql import types as T

    from cobble.session import shared_scratch
    from cobble.sources.io import read_geojson_features, write_feature_lines

    path = shared_scratch(spark, "features")
    write_feature_lines(TD.segment_features(spark, sf_dir), path, FEATURE_PROPS)
    props = T.StructType(
        [T.StructField("physicalid", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in FEATURE_PROPS[1:-1]]
        + [T.StructField("ord", T.LongType())]
    )
    return read_geojson_features(spark, path, props)


# --------------------------------------------------------------------------- streaming


#: Rows of an arriving file; a batch reads at most this many files, but for jobs that need them in order.
EVENTS_PER_FILE, FILES_PER_BATCH = 10_000, 8


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """The events table as files in no order of time, their number following the table's
    size, the shape of a stream's arriving files; written once per session."""
    ev = table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    # max(2, ...): even the smallest table arrives in more than one file.
    n = max(2, -(-ev.count() // EVENTS_PER_FILE))
    return TD.written_path(spark, "event_files", sf_dir, lambda: ev.repartition(n, "event_id"))


def _event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = FILES_PER_BATCH) -> DataFrame:
    from cobble.sources.io import read_stream

    path = _event_files(spark, sf_dir)
    # The schema as written, so a column is never left out.
    return read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=files_per_batch)


@register("stream_hour_histogram")
def stream_hour_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 / IO10: hour histogram over a file stream of events."""
    from cobble.streaming import jobs

    return jobs.run_available(spark, jobs.hour_histogram(_event_stream(spark, sf_dir)), "stream_hour_histogram")


@register("stream_first_event_of_day")
def stream_first_event_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole first event of each day over a file stream."""
    from cobble.streaming import jobs

    s = jobs.first_event_of_day(_event_stream(spark, sf_dir), EVENT_COLUMNS)
    return jobs.run_available(spark, s, "stream_first_event_of_day")


@register("stream_closed_days")
def stream_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 in append mode: the first event of each day that the watermark has closed, each
    emitted once (days that end an hour or more before the latest event). The files come in
    no order of time, so the stream takes them in one batch and none is late."""
    from cobble.streaming import jobs

    s = jobs.first_event_of_day_windowed(_event_stream(spark, sf_dir, None), EVENT_COLUMNS, late="1 hour")
    return jobs.run_available(spark, s, "stream_closed_days", mode="append")


@register("stream_late_events")
def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 with late rows: the first event and the number of events of each day over a file stream in no
    order of time, days corrected by what came after they closed and open days flushed."""
    from cobble.streaming import jobs

    out = jobs.stream_first_with_late(spark, _event_stream(spark, sf_dir), EVENT_COLUMNS)
    return out["final"].select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n", *EVENT_COLUMNS)


@register("stream_max_concurrent_events")
def stream_max_concurrent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """click/purchase level maximum over a file stream, for any order of arrival."""
    from cobble.streaming import jobs

    delta = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", -1).otherwise(0)
    return jobs.stream_max_level(
        spark, _event_stream(spark, sf_dir), "ts", "event_id", delta, F.col("event_type") == "click"
    )


@register("stream_revenue")
def stream_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct users and value total per event type over a file stream."""
    from cobble.streaming import jobs

    r = jobs.stream_distinct_and_total(spark, _event_stream(spark, sf_dir), "event_type", "user_id", "value")
    return r.select("event_type", F.col("customers").alias("users"), F.col("revenue").cast("double"))


# Fixed values that must equal the reference's: header of the revenue report.
REVENUE_HEADER = ("Product ID", " Customer Count", " Total Revenue")


def write_revenue_report(df: DataFrame, path: str) -> None:
    """Revenue report as headed CSV: 'Product ID, Customer Count, Total Revenue', money with
    two decimals (IO12)."""
    from cobble.sources.io import write_csv

    out = df.select(
        F.col("product").cast("string"),
        F.col("customers").cast("string"),
        F.col("revenue").cast("decimal(38,2)").cast("string"),
    ).toDF(*REVENUE_HEADER)
    write_csv(out, path, header=True)


@register("revenue_csv")
def revenue_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product revenue written as the headed CSV report and read back (IO12, S13)."""
    from cobble.session import shared_scratch
    from cobble.sources.io import read_csv_records

    path = shared_scratch(spark, "revenue_csv")
    write_revenue_report(_product_revenue(spark, sf_dir), path)
    back = read_csv_records(spark, path, "product STRING, customers STRING, revenue STRING")
    return back.select(
        F.col("product").cast("bigint"), F.col("customers").cast("bigint"), F.col("revenue").cast("decimal(18,2)").cast("double")
    )


@register("word_count_split")
def word_count_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased counts of whitespace-separated tokens, str.split() style."""
    from cobble.functions.text import whitespace_tokens
    from cobble.operators.aggregates import token_counts

    d = spread(table(spark, sf_dir, "documents").select("text"))
    return token_counts(d, F.transform(whitespace_tokens("text"), lambda w: F.lower(w)))


@register("unknown_streets")
def unknown_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violation street keys that name no segment label or alias, with their violation
    counts: a table anti-join against the lookup keys (J6)."""
    segments, aliases = V.prepare_segments(TD.segment_features(spark, sf_dir))
    keys = segments.select(F.col("label").alias("street")).unionByName(aliases.select(F.col("alias").alias("street")))
    # Counted first: a hot street is one row when it meets the lookup.
    v = _violations(spark, sf_dir).groupBy("street").agg(F.count(F.lit(1)).alias("violations"))
    return v.join(keys.distinct(), "street", "left_anti")


@register("keywords_sql")
def keywords_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword phrases through SQL: a LATERAL call of the cobble_extract_keywords table
    function over the documents view (V3)."""
    from cobble.functions.sql import register_sql_functions

    register_sql_functions(spark)
    spread(table(spark, sf_dir, "documents").select("doc_id", "text")).createOrReplaceTempView("cobble_documents")
    return spark.sql(
        "SELECT d.doc_id, k.pos, k.keyword FROM cobble_documents d, LATERAL cobble_extract_keywords(d.text) k"
    )


@register("violations_csv")
def violations_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw violation rows written as headed CSV files and read back by column position, header
    lines dropped by value (IO4, IO5): violations per county spelling and year text."""
    raw = TD.violation_rows(spark, sf_dir)
    year = F.substring("issue_date", -4, 4)
    return raw.groupBy("county", year.alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("house_number", "street_name").alias("addresses")
    )


@register("violations_report_lines")
def violations_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship report as written: 'id, counts, slope' lines, read back (IO14, S13)."""
    from cobble.session import shared_scratch
    from cobble.sources.io import read_text

    path = shared_scratch(spark, "report_lines")
    V.report_lines(_violations_report(spark, sf_dir), YEARS).write.text(path)
    return read_text(spark, path).withColumnRenamed("value", "line")


@register("feature_collection")
def feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment features written as FeatureCollection documents, which are cut into features and read
    to property columns (IO7, IO15)."""
    from pyspark.sql import types as T

    from cobble.sources.io import read_geojson_features

    docs = TD.collection_files(spark, sf_dir, FEATURE_PROPS)
    props = T.StructType(
        [T.StructField("physicalid", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in FEATURE_PROPS[1:-1]]
        + [T.StructField("ord", T.LongType())]
    )
    return read_geojson_features(spark, docs, props, collection=True)


@register("column_positions")
def column_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position and name of every column of the widest table, and how many values it holds
    (F19), in one pass."""
    li = table(spark, sf_dir, "lineitem")
    counts = li.agg(*[F.count(c).alias(c) for c in li.columns])
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(c).alias("filled"))
        for i, c in enumerate(li.columns)
    ]
    return counts.select(F.inline(F.array(*cells)))


FIRST_LINES = 100


@register("first_lines")
def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the first hundred lines of text files by their ordinal in the files; the files hold the
    documents' lines in order of (document, line) (F18, K5; the cut is the operator)."""
    from cobble.operators.ordered import first_text_lines

    numbered = first_text_lines(spark, TD.line_files(spark, sf_dir), FIRST_LINES, line_sep="\n")
    field = F.split("value", "\t", 3)
    words = F.filter(F.split(F.trim(F.get(field, 2)), " ", -1), lambda w: w != F.lit(""))
    return numbered.select(
        "ordinal",
        F.get(field, 0).cast("bigint").alias("doc_id"),
        F.get(field, 1).cast("int").alias("line_no"),
        F.size(words).alias("n_words"),
    )


@register("weekday_hour")
def weekday_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per (weekday, hour), Monday = 0 as Python's weekday()."""
    ev = table(spark, sf_dir, "events").select("ts")
    return ev.groupBy(F.weekday("ts").cast("int").alias("weekday"), F.hour("ts").cast("int").alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )
