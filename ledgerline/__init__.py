"""Spark-first library of data-pipeline operators: snapshots, change feeds, SCD2, streams, data quality."""
