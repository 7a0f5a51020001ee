"""DuckDB restatements of the registered queries, over the pre-registered table views.

Each SQL string yields the same column names and values as the Spark query of the same key.
"""

from __future__ import annotations

# Fixed values, written out here a second time so that a wrong table in the code under test
# shows: borough spellings by code, part types, ordinal endings of the test streets.
BOROUGH_SPELLINGS = {
    1: ("MAN", "MH", "MN", "NEWY", "NEW Y", "NY"),
    2: ("BRONX", "BX"),
    3: ("BK", "K", "KING", "KINGS"),
    4: ("Q", "QN", "QNS", "QU", "QUEEN"),
    5: ("R", "RICHMOND"),
}
ALL_BOROUGH_SPELLINGS = tuple(s for names in BOROUGH_SPELLINGS.values() for s in names)
PROBE_BOROUGHS = (*ALL_BOROUGH_SPELLINGS, "XX", " ")
PART_TYPES = ("STANDARD", "MEDIUM", "PROMO", "LARGE", "ECONOMY", "SMALL")
ORDINAL_ENDINGS = ("th st", "st st", "nd st")

ORACLES: dict[str, str] = {}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_pick(index_sql: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"(CASE {index_sql} {arms} END)"


def _in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _borough_code_sql(col: str) -> str:
    arms = " ".join(f"WHEN {col} IN {_in_list(names)} THEN {code}" for code, names in BOROUGH_SPELLINGS.items())
    return f"(CASE {arms} END)"


# Street key: upper-case, strip TH/ST/ND from words that start with a digit, drop whitespace.
def _street_key_sql(col: str, strip: bool = True) -> str:
    if not strip:
        return f"regexp_replace(upper({col}), '\\s+', '', 'g')"
    return (
        f"array_to_string(list_transform(string_split_regex(upper({col}), '\\s+'), "
        f"lambda t: CASE WHEN regexp_matches(t, '^[0-9].*(TH|ST|ND)$') THEN left(t, length(t) - 2) ELSE t END), '')"
    )


def _int_or_null(p: str) -> str:
    # DuckDB's TRY_CAST('5.0' AS BIGINT) is 5; Python's int() refuses it, so guard the shape.
    return f"CASE WHEN regexp_full_match({p}, '\\s*\\+?[0-9]+\\s*') THEN TRY_CAST({p} AS BIGINT) END"


def _ends_sql(col: str) -> str:
    arr = f"list_transform(string_split({col}, '-'), lambda p: {_int_or_null('p')})"
    return f"(CASE WHEN {col} IS NULL OR len(list_filter({arr}, lambda v: v IS NULL)) > 0 THEN NULL ELSE {arr} END)"


YEARS = (2015, 2016, 2017, 2018, 2019)

_VIOLATION_ROWS = f"""
  SELECT
    CASE WHEN l_orderkey % 50 = 0 THEN ''
         ELSE lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || '/' || lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0')
              || '/' || CAST(year(l_shipdate) + 20 AS VARCHAR) END AS issue_date,
    {_case_pick(f'l_suppkey % {len(PROBE_BOROUGHS)}', PROBE_BOROUGHS)} AS county,
    CASE (l_orderkey + l_linenumber) % 10
      WHEN 0 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR)
      WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'A'
      WHEN 2 THEN CAST(l_linenumber AS VARCHAR) || '-' || CAST(CAST(l_quantity AS INT) AS VARCHAR)
      WHEN 3 THEN CAST(l_linenumber AS VARCHAR) || '-' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'B'
      WHEN 4 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'AB'
      WHEN 5 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || '-'
      WHEN 6 THEN 'A'
      WHEN 7 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' - ' || CAST(l_linenumber AS VARCHAR)
      WHEN 8 THEN CAST(CAST(l_quantity AS INT) * 3 AS VARCHAR)
      ELSE '' END AS house_number,
    CASE l_partkey % 4
      WHEN 0 THEN 'w ' || CAST(l_suppkey % 25 + 1 AS VARCHAR) || {_case_pick('(l_suppkey % 25 + 1) % 3', ORDINAL_ENDINGS)}
      WHEN 1 THEN lower({_case_pick('l_suppkey % 6', PART_TYPES)}) || ' ave'
      WHEN 2 THEN 'W  ' || CAST(l_suppkey % 25 + 1 AS VARCHAR) || ' ST'
      ELSE CAST(l_suppkey % 25 + 1 AS VARCHAR) || 'rd ave' END AS street_name
  FROM lineitem
"""

_FEATURES = """
  SELECT p_partkey AS physicalid,
    'W ' || regexp_extract(p_brand, '#([0-9]+)', 1) || ' ST' AS st_label,
    CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE p_type || ' AVE' END AS full_stree,
    CAST(p_partkey % 5 + 1 AS VARCHAR) AS borocode,
    CASE WHEN p_partkey % 4 = 0 THEN '1-' || CAST(p_size % 10 AS VARCHAR) ELSE CAST(p_size % 20 AS VARCHAR) END AS l_low_hn,
    CASE WHEN p_partkey % 4 = 0 THEN '7-' || CAST(p_size % 10 + 40 AS VARCHAR) ELSE CAST(p_size % 20 + 25 AS VARCHAR) END AS l_high_hn,
    CASE WHEN p_partkey % 4 = 0 THEN '1-' || CAST(p_size % 8 * 2 AS VARCHAR) ELSE CAST(p_size % 10 * 2 AS VARCHAR) END AS r_low_hn,
    (CASE WHEN p_partkey % 4 = 0 THEN '7-' || CAST(p_size % 8 * 2 + 40 AS VARCHAR) ELSE CAST(p_size % 10 * 2 + 30 AS VARCHAR) END)
      || CASE WHEN p_partkey % 97 = 0 THEN 'A' ELSE '' END AS r_high_hn,
    p_partkey AS ord
  FROM part
"""

_YCOUNTS = ", ".join(f"CAST(count(*) FILTER (WHERE year = {y}) AS BIGINT) AS y{y}" for y in YEARS)

_RESOLVE = f"""
WITH raw AS ({_VIOLATION_ROWS}),
viol AS (
  SELECT CAST(right(issue_date, 4) AS INT) AS year, {_borough_code_sql('county')} AS borough,
         house_number AS house, {_street_key_sql('street_name')} AS street
  FROM raw
  WHERE issue_date IS NOT NULL AND issue_date NOT IN ('', ' ')
    AND county IS NOT NULL AND county NOT IN ('', ' ')
    AND house_number IS NOT NULL AND house_number NOT IN ('', ' ')
    AND street_name IS NOT NULL AND street_name NOT IN ('', ' ')
    AND right(issue_date, 4) IN {_in_list([str(y) for y in YEARS])}
    AND county IN {_in_list(ALL_BOROUGH_SPELLINGS)}
),
addr0 AS (SELECT street, borough, house, {_YCOUNTS} FROM viol GROUP BY street, borough, house),
addr1 AS (
  SELECT *, string_split(house, '-') AS raw_parts,
         list_transform(string_split(house, '-'),
           lambda p: CASE WHEN length(p) >= 2 AND NOT regexp_matches(right(p, 1), '[0-9]') THEN left(p, length(p) - 1) ELSE p END) AS tr
  FROM addr0
),
addr2 AS (
  SELECT *, regexp_full_match(tr[1], '[0-9]+') AS first_digits,
         list_transform(tr, lambda p: {_int_or_null('p')}) AS ints
  FROM addr1
),
addr AS (
  SELECT street, borough, house, {", ".join(f"y{y}" for y in YEARS)}, ints AS parts, ints[-1] % 2 AS side
  FROM addr2
  WHERE len(list_filter(raw_parts, lambda p: length(p) = 0)) = 0
    AND NOT (first_digits = false AND len(list_filter(raw_parts, lambda p: length(p) = 1)) > 0)
    AND len(list_filter(ints, lambda v: v IS NULL)) = 0
),
feat AS ({_FEATURES}),
seg0 AS (
  SELECT {_street_key_sql('st_label', False)} AS label, {_street_key_sql('full_stree', False)} AS alias,
         TRY_CAST(borocode AS INT) AS borough,
         {_ends_sql('l_low_hn')} AS l_low, {_ends_sql('l_high_hn')} AS l_high,
         {_ends_sql('r_low_hn')} AS r_low, {_ends_sql('r_high_hn')} AS r_high,
         CAST(physicalid AS BIGINT) AS pid, CAST(ord AS BIGINT) AS ord
  FROM feat
),
seg AS (
  SELECT * FROM seg0
  WHERE label IS NOT NULL AND alias IS NOT NULL AND borough IS NOT NULL
    AND l_low IS NOT NULL AND l_high IS NOT NULL AND r_low IS NOT NULL AND r_high IS NOT NULL
),
aliases AS (SELECT alias, label, min(ord) AS aord FROM seg GROUP BY alias, label),
lk AS (
  SELECT label AS key, borough, l_low, l_high, r_low, r_high, pid, ord, 0 AS pri, CAST(0 AS BIGINT) AS aord FROM seg
  UNION ALL
  SELECT a.alias AS key, s.borough, s.l_low, s.l_high, s.r_low, s.r_high, s.pid, s.ord, 1 AS pri, a.aord
  FROM aliases a JOIN seg s ON s.label = a.label WHERE a.alias <> a.label
),
lookup AS (
  SELECT key, borough, 1 AS side, l_low AS low, l_high AS high, pid, ord, pri, aord FROM lk
  UNION ALL
  SELECT key, borough, 0 AS side, r_low AS low, r_high AS high, pid, ord, pri, aord FROM lk
),
cand AS (
  SELECT a.*, l.pid, row_number() OVER (PARTITION BY a.street, a.borough, a.house ORDER BY l.pri, l.aord, l.ord) AS rn
  FROM addr a JOIN lookup l
    ON a.street = l.key AND a.borough = l.borough AND a.side = l.side
   AND len(a.parts) = len(l.low) AND len(a.parts) = len(l.high)
   AND list_bool_and(list_transform(range(1, len(a.parts) + 1), lambda i: l.low[i] <= a.parts[i] AND a.parts[i] <= l.high[i]))
),
matched AS (SELECT * FROM cand WHERE rn = 1)
"""

_SLOPE = (
    "((((0.0 + (-2.0) * (CAST(y2015 AS DOUBLE) - ym)) + (-1.0) * (CAST(y2016 AS DOUBLE) - ym))"
    " + 0.0 * (CAST(y2017 AS DOUBLE) - ym)) + 1.0 * (CAST(y2018 AS DOUBLE) - ym)) + 2.0 * (CAST(y2019 AS DOUBLE) - ym)"
)

ORACLES["resolve_segments"] = (
    _RESOLVE
    + f"SELECT street, borough, house, pid, CAST({' + '.join(f'y{y}' for y in YEARS)} AS BIGINT) AS violations FROM matched"
)

ORACLES["violations_by_segment"] = (
    _RESOLVE
    + f""",
per_pid AS (
  SELECT pid, {", ".join(f"CAST(sum(y{y}) AS BIGINT) AS y{y}" for y in YEARS)} FROM matched GROUP BY pid
),
trend AS (
  SELECT *, (({_SLOPE}) / 10.0) AS slope FROM (
    SELECT *, ((((CAST(y2015 AS DOUBLE) + CAST(y2016 AS DOUBLE)) + CAST(y2017 AS DOUBLE)) + CAST(y2018 AS DOUBLE))
               + CAST(y2019 AS DOUBLE)) / 5.0 AS ym FROM per_pid)
),
roster AS (
  SELECT p_partkey AS pid FROM part UNION ALL SELECT p_partkey FROM part WHERE p_partkey % 100 = 0
),
copies AS (SELECT pid, count(*) AS n FROM roster GROUP BY pid),
joined AS (
  SELECT coalesce(c.pid, t.pid) AS pid, c.n,
         {", ".join(f"coalesce(t.y{y}, 0) AS y{y}" for y in YEARS)}, coalesce(t.slope, 0.0) AS slope
  FROM copies c FULL OUTER JOIN trend t ON c.pid = t.pid
)
SELECT pid, {", ".join(f"y{y}" for y in YEARS)}, slope, CAST(g.copy AS BIGINT) AS copy
FROM joined, LATERAL (SELECT unnest(generate_series(1, coalesce(joined.n, 1))) AS copy) g
ORDER BY pid, copy
"""
)


ORACLES["reconcile_total"] = (
    "WITH rep AS ("
    + ORACLES["violations_by_segment"].replace("ORDER BY pid, copy", "")
    + f") SELECT CAST(coalesce(sum({' + '.join(f'y{y}' for y in YEARS)}), 0) AS BIGINT) AS total FROM rep"
)

ORACLES["complaints_report"] = """
WITH rows AS (
  SELECT nullif(p_brand, 'Brand#7') AS product, substr(CAST(l_shipdate AS VARCHAR), 1, 4) AS year, l_suppkey AS company
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
per AS (
  SELECT product, year, company, count(*) AS n FROM rows
  WHERE product IS NOT NULL AND company IS NOT NULL AND year IS NOT NULL
  GROUP BY product, year, company
)
SELECT product, year, CAST(sum(n) AS BIGINT) AS complaints, CAST(count(*) AS BIGINT) AS companies,
       CAST(round_even(CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100.0, 0) AS INT) AS top_share_pct
FROM per GROUP BY product, year
"""

ORACLES["product_revenue"] = """
WITH per AS (
  SELECT l_partkey AS product, o_custkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey, o_custkey
)
SELECT product, CAST(count(*) AS BIGINT) AS customers, CAST(sum(amt) AS DOUBLE) AS revenue FROM per GROUP BY product
"""

ORACLES["customer_runs"] = """
WITH r AS (
  SELECT event_type, user_id, lag(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM events
),
runs AS (
  SELECT event_type, CAST(sum(CASE WHEN prev IS NULL OR prev <> user_id THEN 1 ELSE 0 END) AS BIGINT) AS runs
  FROM r GROUP BY event_type
),
per AS (
  SELECT event_type, user_id, sum(CAST(value AS DECIMAL(18,2))) AS amt FROM events GROUP BY event_type, user_id
),
ex AS (SELECT event_type, CAST(count(*) AS BIGINT) AS users, CAST(sum(amt) AS DOUBLE) AS revenue FROM per GROUP BY event_type)
SELECT runs.event_type, runs, users, revenue FROM runs JOIN ex USING (event_type)
"""

_TRIPS = """
trips AS (
  SELECT ns.n_name AS start_station, nc.n_name AS end_station, o_orderpriority AS usertype,
         CAST(c_custkey % 3 AS INT) AS gender
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ns ON s_nationkey = ns.n_nationkey
  JOIN nation nc ON c_nationkey = nc.n_nationkey
)"""

_STATION_TRIPS = f"""
WITH {_TRIPS},
ends AS (SELECT start_station AS station FROM trips UNION ALL SELECT end_station FROM trips)
SELECT station, CAST(count(*) AS BIGINT) AS trips FROM ends GROUP BY station
"""
ORACLES["station_trips"] = _STATION_TRIPS
ORACLES["busy_stations"] = (
    f"WITH st AS ({_STATION_TRIPS}) SELECT * FROM st WHERE trips > (SELECT sum(trips) / count(*) FROM st)"
)
ORACLES["station_pairs"] = f"""
WITH {_TRIPS}
SELECT least(start_station, end_station) AS station_a, greatest(start_station, end_station) AS station_b,
       CAST(count(*) AS BIGINT) AS trips
FROM trips GROUP BY 1, 2
"""
ORACLES["top_station_by_group"] = f"""
WITH {_TRIPS},
c AS (
  SELECT CASE gender WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS gender,
         start_station, CAST(count(*) AS BIGINT) AS trips
  FROM trips WHERE usertype = '1-URGENT' GROUP BY 1, 2
),
r AS (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY trips DESC, start_station) AS rn FROM c)
SELECT gender, start_station, trips FROM r WHERE rn = 1
"""

_WORD = "[\\p{L}\\p{N}_]+"
_WORD_APOS = "[\\p{L}\\p{N}_'']+"

_SPACE_COUNTS = """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT unnest(string_split(trim(line), ' ')) AS word FROM lines)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM w WHERE word <> '' GROUP BY word
"""
_LOWER_COUNTS = f"""
WITH w AS (SELECT unnest(regexp_extract_all(text, '{_WORD_APOS}')) AS word FROM documents)
SELECT lower(word) AS word, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY lower(word)
"""
ORACLES["word_count_spaces"] = _SPACE_COUNTS
ORACLES["word_count_lower"] = _LOWER_COUNTS
ORACLES["top_words"] = f"SELECT * FROM ({_SPACE_COUNTS}) ORDER BY n DESC, word LIMIT 10"
ORACLES["top3_words"] = f"SELECT * FROM ({_LOWER_COUNTS}) ORDER BY n DESC, word LIMIT 3"
ORACLES["most_used_word"] = f"SELECT n, word FROM ({_LOWER_COUNTS}) ORDER BY n DESC, word DESC LIMIT 1"

_STOP = "('the', 'of', 'when', 'in')"
# Gaps and islands: a word that is neither capitalised nor a stopword ends an island; an island
# counts from its first word that is no stopword, if two or more words are left.
ORACLES["keywords"] = f"""
WITH sent AS (
  SELECT doc_id, generate_subscripts(string_split(text, '.'), 1) AS s_no, unnest(string_split(text, '.')) AS sent FROM documents
),
tok AS (
  SELECT doc_id, s_no, generate_subscripts(ws, 1) AS i, unnest(ws) AS w
  FROM (SELECT doc_id, s_no, regexp_extract_all(sent, '{_WORD}') AS ws FROM sent)
),
cls AS (SELECT *, lower(w) IN {_STOP} AS is_stop, regexp_matches(w, '^\\p{{Lu}}') AS cap FROM tok),
isl AS (
  SELECT *, sum(CASE WHEN cap OR is_stop THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, s_no ORDER BY i) AS g FROM cls
),
led AS (
  SELECT *, min(CASE WHEN NOT is_stop THEN i END) OVER (PARTITION BY doc_id, s_no, g) AS f FROM isl WHERE cap OR is_stop
),
phr AS (
  SELECT doc_id, s_no, g, min(i) AS lead_i, string_agg(w, ' ' ORDER BY i) AS keyword
  FROM led WHERE i >= f GROUP BY doc_id, s_no, g HAVING count(*) >= 2
)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s_no, lead_i) - 1 AS INT) AS pos, keyword FROM phr
"""

ORACLES["hour_histogram"] = "SELECT CAST(hour(ts) AS INT) AS hour, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1"

ORACLES["first_event_of_day"] = """
WITH r AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, event_id, ts, user_id, event_type, value, props,
         row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS rn
  FROM events
)
SELECT day, event_id, ts, user_id, event_type, value, props FROM r WHERE rn = 1
"""

ORACLES["max_concurrent_events"] = """
WITH e AS (
  SELECT ts, event_id, event_type,
         CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END AS d
  FROM events
),
r AS (SELECT event_type, sum(d) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS lvl FROM e WHERE d <> 0)
SELECT CAST(greatest(0, coalesce(max(lvl) FILTER (WHERE event_type = 'click'), 0)) AS BIGINT) AS max_level FROM r
"""

ORACLES["max_concurrent_trips"] = """
WITH t AS (
  SELECT least(o_orderdate, l_shipdate) AS start, greatest(o_orderdate, l_shipdate) AS stop, l_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
e AS (
  SELECT start AS t, 1 AS k, l_orderkey AS id, 1 AS d FROM t
  UNION ALL SELECT stop, 0, l_orderkey, -1 FROM t
),
r AS (SELECT d, sum(d) OVER (ORDER BY t, k, id ROWS UNBOUNDED PRECEDING) AS lvl FROM e)
SELECT CAST(greatest(0, coalesce(max(lvl) FILTER (WHERE d > 0), 0)) AS BIGINT) AS max_concurrent FROM r
"""

_STATUS = """
sl AS (
  SELECT o_orderkey,
         array_to_string(list_transform(nums, lambda x: CAST(x AS VARCHAR)), ',') || ' : ' ||
         CASE o_orderstatus WHEN 'F' THEN 'Good Service' WHEN 'O' THEN 'Delays' WHEN 'P' THEN 'Planned Work' END AS status_line
  FROM (SELECT l_orderkey, list_sort(list(l_linenumber)) AS nums FROM lineitem GROUP BY l_orderkey) g
  JOIN orders ON l_orderkey = o_orderkey
)"""
ORACLES["delayed_lines"] = f"""
WITH {_STATUS},
d AS (SELECT o_orderkey, string_split(string_split(status_line, ' : ')[1], ',') AS names FROM sl WHERE contains(status_line, 'Delays'))
SELECT o_orderkey, CAST(generate_subscripts(names, 1) - 1 AS INT) AS pos, unnest(names) AS line FROM d
"""
ORACLES["delayed_line_count"] = f"SELECT CAST(count(*) AS BIGINT) AS n FROM ({ORACLES['delayed_lines']})"
ORACLES["status_lines"] = f"""
WITH {_STATUS},
d AS (
  SELECT o_orderkey, string_split(string_split(status_line, ' : ')[1], ',') AS names,
         string_split(status_line, ' : ')[2] AS st FROM sl
),
u AS (SELECT o_orderkey, st, CAST(generate_subscripts(names, 1) - 1 AS INT) AS pos, unnest(names) AS line FROM d)
SELECT o_orderkey, pos, line || ' : ' || st AS update FROM u
"""

ORACLES["weighted_score"] = """
WITH c AS (
  SELECT c_custkey AS dbn, c_mktsegment AS boro, CAST(CAST(c_acctbal AS INT) AS VARCHAR) AS total_students FROM customer
),
schools AS (
  SELECT dbn, boro FROM c WHERE regexp_full_match(total_students, '[0-9]+') AND CAST(total_students AS BIGINT) > 500
),
o AS (
  SELECT o_custkey AS dbn,
         CASE WHEN o_orderpriority = '5-LOW' THEN 's' ELSE CAST(o_orderkey % 97 + 1 AS VARCHAR) END AS takers,
         CAST(trunc(o_totalprice / 1000) AS BIGINT) % 800 AS score
  FROM orders
),
sat AS (SELECT dbn, CAST(takers AS BIGINT) AS takers, score FROM o WHERE takers <> 's')
SELECT boro, CAST(trunc(CAST(sum(score * takers) AS DOUBLE) / CAST(sum(takers) AS DOUBLE)) AS BIGINT) AS mean_score
FROM schools JOIN sat USING (dbn) GROUP BY boro
"""

ORACLES["numeric_audit"] = """
WITH v AS (
  SELECT 'c_name_suffix' AS source, split_part(c_name, '#', 2) AS v FROM customer
  UNION ALL SELECT 'p_name_token', unnest(string_split(p_name, ' ')) FROM part
  UNION ALL SELECT 'priority_head', split_part(o_orderpriority, '-', 1) FROM orders
  UNION ALL SELECT 'quantity_text', CAST(l_quantity AS VARCHAR) FROM lineitem
)
SELECT source, CASE WHEN regexp_full_match(v, '[0-9]+') THEN 'Number' ELSE 'Not a Number' END AS label,
       CAST(count(*) AS BIGINT) AS n
FROM v GROUP BY 1, 2
"""

ORACLES["words_not_in"] = """
WITH j AS (
  SELECT c.conv_id, c.turn, c.text, coalesce(p.text, '') AS prev_text
  FROM conversations c LEFT JOIN conversations p ON c.conv_id = p.conv_id AND c.turn = p.turn + 1
),
w AS (
  SELECT conv_id, turn,
         list_filter(string_split(lower(text), ' '), lambda x: x <> '' AND NOT list_contains(string_split(lower(prev_text), ' '), x)) AS new
  FROM j
)
SELECT conv_id, turn, array_to_string(new, ' ') AS new_words, CAST(len(new) AS INT) AS n_new FROM w
"""

ORACLES["distinct_chars"] = """
SELECT p_partkey,
       CAST(CASE WHEN length(p_name) = 0 THEN 0 ELSE len(list_distinct(string_split(p_name, ''))) END AS INT) AS n_chars,
       CAST(len(list_distinct(string_split(p_name, ' '))) AS INT) AS n_words
FROM part
"""

ORACLES["normalise_street"] = f"""
WITH t AS (
  SELECT p_partkey,
         CAST(p_size AS VARCHAR) || CASE p_size % 4 WHEN 0 THEN 'TH' WHEN 1 THEN 'st' WHEN 2 THEN 'ND' ELSE 'RD' END
           || '  ' || p_name || ' 1st' AS raw
  FROM part
)
SELECT p_partkey, raw, {_street_key_sql('raw')} AS street FROM t
"""

ORACLES["house_parts"] = f"""
WITH h AS (SELECT DISTINCT house_number AS house FROM ({_VIOLATION_ROWS})),
a1 AS (
  SELECT house, string_split(house, '-') AS raw_parts,
         list_transform(string_split(house, '-'),
           lambda p: CASE WHEN length(p) >= 2 AND NOT regexp_matches(right(p, 1), '[0-9]') THEN left(p, length(p) - 1) ELSE p END) AS tr
  FROM h
),
a2 AS (SELECT *, regexp_full_match(tr[1], '[0-9]+') AS first_digits, list_transform(tr, lambda p: {_int_or_null('p')}) AS ints FROM a1),
a3 AS (
  SELECT house,
         CASE WHEN len(list_filter(raw_parts, lambda p: length(p) = 0)) = 0
               AND NOT (first_digits = false AND len(list_filter(raw_parts, lambda p: length(p) = 1)) > 0)
               AND len(list_filter(ints, lambda v: v IS NULL)) = 0 THEN ints END AS parts
  FROM a2
)
SELECT house, array_to_string(list_transform(parts, lambda x: CAST(x AS VARCHAR)), ',') AS parts,
       CAST(parts[-1] % 2 AS INT) AS parity
FROM a3
"""

_TY = (1995, 1996, 1997, 1998, 1999)
_TSLOPE = (
    f"((((0.0 + (-2.0) * (CAST(y{_TY[0]} AS DOUBLE) - ym)) + (-1.0) * (CAST(y{_TY[1]} AS DOUBLE) - ym))"
    f" + 0.0 * (CAST(y{_TY[2]} AS DOUBLE) - ym)) + 1.0 * (CAST(y{_TY[3]} AS DOUBLE) - ym)) + 2.0 * (CAST(y{_TY[4]} AS DOUBLE) - ym)"
)
ORACLES["yearly_trend"] = f"""
WITH o AS (SELECT o_custkey AS pid, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) IN {tuple(_TY)}),
per AS (SELECT pid, {", ".join(f"CAST(count(*) FILTER (WHERE year = {y}) AS BIGINT) AS y{y}" for y in _TY)} FROM o GROUP BY pid),
trend AS (
  SELECT *, (({_TSLOPE}) / 10.0) AS slope FROM (
    SELECT *, ((((CAST(y{_TY[0]} AS DOUBLE) + CAST(y{_TY[1]} AS DOUBLE)) + CAST(y{_TY[2]} AS DOUBLE)) + CAST(y{_TY[3]} AS DOUBLE))
               + CAST(y{_TY[4]} AS DOUBLE)) / 5.0 AS ym FROM per)
),
roster AS (SELECT c_custkey AS pid FROM customer UNION ALL SELECT -c_custkey - 1 FROM customer WHERE c_custkey % 10 = 0),
copies AS (SELECT pid, count(*) AS n FROM roster GROUP BY pid),
joined AS (
  SELECT coalesce(c.pid, t.pid) AS pid, c.n, {", ".join(f"coalesce(t.y{y}, 0) AS y{y}" for y in _TY)},
         coalesce(t.slope, 0.0) AS slope
  FROM copies c FULL OUTER JOIN trend t ON c.pid = t.pid
)
SELECT pid, {", ".join(f"y{y}" for y in _TY)}, slope, CAST(g.copy AS BIGINT) AS copy
FROM joined, LATERAL (SELECT unnest(generate_series(1, coalesce(joined.n, 1))) AS copy) g
ORDER BY pid, copy
"""

ORACLES["csv_roundtrip"] = """
SELECT p_partkey, p_name || ', "' || p_type || '"' || chr(10) || p_brand AS description,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price
FROM part
"""

ORACLES["text_roundtrip"] = (
    "SELECT pid, " + ", ".join(f"y{y}" for y in _TY) + ", slope FROM ("
    + ORACLES["yearly_trend"].replace("ORDER BY pid, copy", "") + ")"
)

ORACLES["id_list"] = "SELECT c_custkey AS pid FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0"

ORACLES["feature_explode"] = f"SELECT * FROM ({_FEATURES})"

ORACLES["stream_hour_histogram"] = ORACLES["hour_histogram"]
ORACLES["stream_first_event_of_day"] = ORACLES["first_event_of_day"]
ORACLES["stream_closed_days"] = f"""
SELECT * FROM ({ORACLES['first_event_of_day']})
WHERE CAST(day AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
"""
ORACLES["stream_late_events"] = f"""
SELECT f.*, c.n FROM ({ORACLES['first_event_of_day']}) f
JOIN (SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1) c USING (day)
"""
ORACLES["stream_max_concurrent_events"] = ORACLES["max_concurrent_events"]
ORACLES["stream_revenue"] = """
WITH per AS (
  SELECT event_type, user_id, sum(CAST(value AS DECIMAL(18,2))) AS amt FROM events GROUP BY event_type, user_id
)
SELECT event_type, CAST(count(*) AS BIGINT) AS users, CAST(sum(amt) AS DOUBLE) AS revenue FROM per GROUP BY event_type
"""

ORACLES["revenue_csv"] = ORACLES["product_revenue"]

ORACLES["word_count_split"] = """
WITH w AS (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents)
SELECT lower(word) AS word, CAST(count(*) AS BIGINT) AS n FROM w WHERE word <> '' GROUP BY lower(word)
"""

ORACLES["unknown_streets"] = (
    _RESOLVE.split("addr0 AS")[0].rstrip().rstrip(",")
    + """,
feat AS (""" + _FEATURES + """),
seg0 AS (
  SELECT """ + _street_key_sql("st_label", False) + """ AS label, """ + _street_key_sql("full_stree", False) + """ AS alias,
         TRY_CAST(borocode AS INT) AS borough,
         """ + _ends_sql("l_low_hn") + """ AS l_low, """ + _ends_sql("l_high_hn") + """ AS l_high,
         """ + _ends_sql("r_low_hn") + """ AS r_low, """ + _ends_sql("r_high_hn") + """ AS r_high
  FROM feat
),
seg AS (
  SELECT * FROM seg0
  WHERE label IS NOT NULL AND alias IS NOT NULL AND borough IS NOT NULL
    AND l_low IS NOT NULL AND l_high IS NOT NULL AND r_low IS NOT NULL AND r_high IS NOT NULL
),
keys AS (SELECT label AS street FROM seg UNION ALL SELECT alias FROM seg)
SELECT street, CAST(count(*) AS BIGINT) AS violations FROM viol
WHERE NOT EXISTS (SELECT 1 FROM keys k WHERE k.street = viol.street)
GROUP BY street
"""
)

ORACLES["keywords_sql"] = ORACLES["keywords"]

ORACLES["weekday_hour"] = (
    "SELECT CAST(isodow(ts) - 1 AS INT) AS weekday, CAST(hour(ts) AS INT) AS hour, CAST(count(*) AS BIGINT) AS n "
    "FROM events GROUP BY 1, 2"
)

ORACLES["violations_csv"] = f"""
SELECT county, right(issue_date, 4) AS year, CAST(count(*) AS BIGINT) AS n,
       CAST(count(DISTINCT (house_number, street_name)) AS BIGINT) AS addresses
FROM ({_VIOLATION_ROWS}) GROUP BY 1, 2
"""

ORACLES["violations_report_lines"] = f"""
SELECT concat_ws(', ', CAST(pid AS VARCHAR), {", ".join(f"CAST(y{y} AS VARCHAR)" for y in YEARS)},
         CASE WHEN {" + ".join(f"y{y}" for y in YEARS)} = 0 THEN '0' ELSE CAST(slope AS VARCHAR) END) AS line
FROM ({ORACLES['violations_by_segment']})
"""

ORACLES["violations_incremental"] = ORACLES["violations_by_segment"]

ORACLES["feature_collection"] = ORACLES["feature_explode"]

ORACLES["first_lines"] = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, unnest(string_split(text, chr(10))) AS line
  FROM documents
),
n AS (SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS ordinal, * FROM lines)
SELECT CAST(ordinal AS BIGINT) AS ordinal, doc_id, CAST(line_no AS INT) AS line_no,
       CAST(len(list_filter(string_split(trim(line), ' '), lambda w: w <> '')) AS INT) AS n_words
FROM n WHERE ordinal < 100
"""

# The columns of lineitem in their order.
_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
ORACLES["column_positions"] = " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{c}' AS name, CAST(count({c}) AS BIGINT) AS filled FROM lineitem"
    for i, c in enumerate(_LINEITEM)
)
