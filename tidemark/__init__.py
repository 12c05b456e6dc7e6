"""tidemark: business marts and data-quality operators on Spark DataFrames.

Layout
------
functions/  Column builders (hashing, rules, exact averages, date parts, trim)
operators/  DataFrame -> DataFrame operators (dedup, profile, windows, upsert)
sources/    file / JDBC readers, declared schemas, incremental watermarks
sinks/      overwrite, idempotent append by batch, versioned upsert, staging
plans/      the five marts and the read -> build -> stage -> write runner
streaming/  incremental file ingest through Structured Streaming
"""

__version__ = "0.1.0"
