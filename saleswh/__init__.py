"""saleswh — a Spark-native sales warehouse.

Layers (all DataFrame -> DataFrame, executed by Catalyst/Tungsten):

* ``functions``  column expressions for SAP source quirks (ALPHA codes,
  trailing-minus amounts, ``/Date(ms)/`` stamps, row hashes, payloads).
* ``sources``    landed OData pages, entity maps, incremental slices,
  file-stream ingest and the bridge from the test tables to RAW/bronze.
* ``operators``  reusable relational building blocks: latest-row dedup,
  surrogate keys, merges (upsert / insert-only / SCD1 / SCD2 / quarantine),
  data-quality rule chains, constraint checks.
* ``plans``      the warehouse itself: staging, dimensions, facts, marts,
  analytics (forecast, anomalies, drivers, text) and governance views.
* ``streaming``  ``readStream`` -> ``foreachBatch`` runners with
  checkpoints and snapshot commits.
"""

__version__ = "0.1.0"
