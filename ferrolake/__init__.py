"""ferrolake: an orders / customers / payments lakehouse written as PySpark DataFrame jobs.

Layers: ``sources`` (Bronze readers, streams, seeds), ``plans`` (Silver and Gold models, reports,
lineage), ``operators`` (dedup, upsert, layout, history, audit, quality, publish, classify),
``functions`` (column-level helpers) and ``streaming`` (file ingest, late-data upserts).
"""

__all__ = ["session", "sources", "plans", "operators", "functions", "streaming"]
