"""cobble: Spark-native analytics jobs (DataFrame, Spark SQL, Structured Streaming).

Import the modules you need:

    from cobble.functions import text, streets      # Column functions
    from cobble.operators import aggregates, ordered, joins, violations
    from cobble.sources import io                   # readers and writers
    from cobble.streaming import jobs as streams    # streaming forms
    from cobble import jobs                         # file-to-file jobs (spark-submit)
"""

__all__ = ["functions", "operators", "sources", "streaming", "plans", "jobs", "session"]
