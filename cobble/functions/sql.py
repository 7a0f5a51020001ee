"""SQL access to the text functions: session-scoped SQL functions built from Spark's own
higher-order functions (no Python runs per row).

    register_sql_functions(spark)
    spark.sql("SELECT d.doc_id, k.pos, k.keyword FROM documents d, LATERAL cobble_extract_keywords(d.text) k")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cobble.functions.streets import street_key_sql
from cobble.functions.text import NOT_NUMBER_LABEL, NUMBER_LABEL, keywords_sql

KEYWORDS_SQL = keywords_sql("t")
STREET_KEY_SQL = street_key_sql("t")
NUMBER_LABEL_SQL = rf"CASE WHEN t RLIKE '\\A[0-9]+\\z' THEN '{NUMBER_LABEL}' ELSE '{NOT_NUMBER_LABEL}' END"


def register_sql_functions(spark: SparkSession) -> None:
    """Create (or replace) the session's cobble_* SQL functions."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION cobble_keywords(t STRING) RETURNS ARRAY<STRING> RETURN {KEYWORDS_SQL}")
    # A SQL function may not sit inside a generator, so the table function inlines the text.
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION cobble_extract_keywords(t STRING) "
        f"RETURNS TABLE(pos INT, keyword STRING) RETURN SELECT posexplode({KEYWORDS_SQL})"
    )
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION cobble_street_key(t STRING) RETURNS STRING RETURN {STREET_KEY_SQL}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION cobble_number_label(t STRING) RETURNS STRING RETURN {NUMBER_LABEL_SQL}")
