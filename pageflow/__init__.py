"""pageflow: page-view ingest, reports and article mining as Spark jobs.

Layout:
  session.py          SparkSession defaults and the shared scratch folder
  schemas.py          every fixed StructType of the data model
  functions/          pure Column expressions (dump-line parsing, file-name time, text measures)
  sources/            dump scans (text / csv / all-string / inferred), file manifests, article corpus
  operators/          keyword dimension, reports, ledger, maintenance, exploration, article mining
  plans/              multi-step jobs: ingest with quarantine, checked broadcast, fixture views
  streaming/          file-arrival loads with Structured Streaming
"""

__all__ = ["session", "schemas"]
