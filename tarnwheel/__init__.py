"""A Spark-first analytics engine: relational, temporal, streaming and text operators on DataFrames."""
