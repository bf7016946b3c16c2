"""dexflow: decentralised-exchange event analytics on Spark.

Subpackages: ``sources`` (readers, constant dimensions, the stored table),
``functions`` (column expressions), ``operators`` (normalisation, enrichment,
reports, checks), ``plans`` (the event-table build, size checks, the query
catalog) and ``streaming`` (the checkpointed micro-batch ingest).
"""
