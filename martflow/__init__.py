"""martflow: analytical marts on Spark DataFrames.

Layout:
  sources/    reads (parquet tables, CSV, JSON landing, staged cursor reads, calendar, views, JDBC)
  functions/  column expressions (descriptor split, AGE day part, month name, JSON text, doc stamps)
  operators/  keys (dense ids, NTILE), latest-per-key, table maintenance (slices, upsert family,
              NOT IN, validity ranges, publish), lookups, cursors, data-quality rules
  plans/      the marts: rfm, orders, shipping, sales (+ run_increment), staging, dds (+ DdsRun), courier
  streaming/  Structured Streaming tail, dedupe and micro-batch upsert

Every function takes and returns lazy DataFrames; writes go to the folder
named by ``spark.checkpoint.dir`` (``martflow.session.shared_dir``).
"""
