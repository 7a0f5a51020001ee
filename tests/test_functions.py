"""Scalar, array and text functions against the small fixtures with known answers."""

from pyspark.sql import functions as F

from cobble.functions import streets as S
from cobble.functions import text as X

# An own text with every rule in it: phrases across line ends, punctuation, hyphens and
# apostrophes, stopwords inside, at the start and at the end, single capitals, digits.
ABOUT = """The Old Mill of Upper Town is a mill and a bakery
all known for the Franco-Swiss bread of Master Baker
Rosa "Nonna" Bell. The mill was built by the people of
the Bell family, whose Rosa's ovens, in 1922, were the first
of their kind. It began with Flour
House in Port Anna, which closed in 1950. When Grand Port Anna
opened, the Port Anna Courier paper called it
a find, and named Rosa Bell
the "Queen of Bread." In 1960, Rosa's Carla Bell
went north to North Lake Mills in When."""

ABOUT_KEYWORDS = [
    "Old Mill of Upper Town",
    "Franco Swiss",
    "Master Baker Rosa Nonna Bell",
    "Flour House in Port Anna",
    "Grand Port Anna",
    "Port Anna Courier",
    "Rosa Bell the Queen of Bread",
    "Carla Bell",
    "North Lake Mills in When",
]

STATUS = [
    "10 : On Time",
    "11,12 : Delays",
    "X,Y,Z : Works",
    "13 : Delays",
    "P,Q : On Time",
    "R,S,R : Delays",
]


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_keywords_about_text(spark):
    assert one(spark, X.keywords("v"), ABOUT) == ABOUT_KEYWORDS


def test_keywords_trailing_stopwords_stay(spark):
    assert one(spark, X.keywords("v"), "He saw House of the cat. ABC of") == ["House of the", "ABC of"]


def test_delayed_lines_and_count(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(STATUS)], "i int, line string")
    names, _ = X.status_line_parts("line")
    rows = (
        df.filter(F.col("line").contains("Delays"))
        .select("i", F.posexplode(names).alias("pos", "name"))
        .orderBy("i", "pos")
        .collect()
    )
    assert [r["name"] for r in rows] == ["11", "12", "13", "R", "S", "R"]


def test_status_lines_expanded_in_order(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(STATUS)], "i int, line string")
    names, status = X.status_line_parts("line")
    rows = (
        df.select("i", status.alias("st"), F.posexplode(names).alias("pos", "name"))
        .orderBy("i", "pos")
        .select(F.concat("name", F.lit(" : "), "st").alias("u"))
        .collect()
    )
    out = [r["u"] for r in rows]
    assert len(out) == 12
    assert out[:4] == ["10 : On Time", "11 : Delays", "12 : Delays", "X : Works"]
    assert out[-3:] == ["R : Delays", "S : Delays", "R : Delays"]


def test_natural_number(spark):
    vals = ["1A", "12", "b1", "0xff", "", "12\n"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(X.natural_number_label("v")).collect()]
    assert got == ["Not a Number", "Number", "Not a Number", "Not a Number", "Not a Number", "Not a Number"]


def test_distinct_elements(spark):
    assert one(spark, X.distinct_count(F.col("v")), [1, 2, 3, 4, 1, 5, 2], "v array<int>") == 5
    assert one(spark, X.distinct_chars(F.col("v")), "hello world") == 8
    assert one(spark, X.distinct_chars(F.col("v")), "") == 0


def test_words_not_in(spark):
    df = spark.createDataFrame(
        [("big data management and analysis", "big data computing"), ("Big  data Big x", "data")], "x string, y string"
    )
    got = [r[0] for r in df.select(X.words_not_in("x", "y")).collect()]
    assert got == [["management", "and", "analysis"], ["big", "big", "x"]]


def test_street_key(spark):
    vals = ["w  8th st", "3rd ave 21ST st 1st", "7TH AVE", "1ST 2ND"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(S.street_key("v")).collect()] == ["W8ST", "3RDAVE21ST1", "7AVE", "12"]


def test_house_parts(spark):
    vals = ["5", "35A", "10 - 4", "92-29", "A", "12AB", "12-B", "A-5", "7A5", "3-", "-3"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(S.house_parts("v")).collect()]
    assert got == [[5], [35], [10, 4], [92, 29], None, None, None, None, None, None, None]


def test_box_not_lexicographic(spark):
    df = spark.createDataFrame([([92, 29], [91, 1], [93, 15]), ([92, 10], [91, 1], [93, 15])], "p array<bigint>, lo array<bigint>, hi array<bigint>")
    assert [r[0] for r in df.select(S.in_box("p", "lo", "hi")).collect()] == [False, True]


def test_slope(spark):
    df = spark.createDataFrame([(34, 0, 0, 0, 0), (0, 0, 0, 0, 0), (1, 2, 3, 4, 5)], "a long, b long, c long, d long, e long")
    got = [r[0] for r in df.select(S.slope_over_years(["a", "b", "c", "d", "e"], [2015, 2016, 2017, 2018, 2019])).collect()]
    assert got == [-6.8, 0.0, 1.0]


def test_whole_percent_half_even(spark):
    from cobble.operators.aggregates import whole_percent

    df = spark.createDataFrame([(1, 8), (9, 24), (23, 40)], "n long, t long")
    got = [r[0] for r in df.select(whole_percent(F.col("n") / F.col("t"))).collect()]
    assert got == [12, 38, 57]


def test_borough_codes(spark):
    vals = ["NEW Y", "BX", "KINGS", "QU", "RICHMOND", "ny", "XX"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(S.borough_code("v")).collect()] == [1, 2, 3, 4, 5, None, None]


def test_weekday_monday_is_zero(spark):
    import datetime

    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 5), ), (datetime.datetime(2024, 1, 7, 23),)], "ts timestamp_ntz")
    got = [(r[0], r[1]) for r in df.select(F.weekday("ts"), F.hour("ts")).collect()]
    assert got == [(datetime.datetime(2024, 1, 1).weekday(), 5), (datetime.datetime(2024, 1, 7).weekday(), 23)] == [(0, 5), (6, 23)]
