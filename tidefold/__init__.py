"""tidefold: change-data-capture processing on Apache Spark.

Snapshots, SQL dump text and ordered row-change logs go in; current keyed
tables, index-ready documents and reconciliation reports come out.  Everything
is a DataFrame transformation, so the same code runs in batch and on a stream.
"""
