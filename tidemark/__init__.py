"""tidemark: incremental ingestion and data governance on Spark.

Entry points: ``tidemark.plans.ingest`` (runs and replays),
``tidemark.plans.load`` (landed pages -> tables), ``tidemark.plans.reports``
(governance reports), ``tidemark.streaming.landing_stream`` (the stream),
``tidemark.plans.catalog`` (registered queries with their oracles).
"""

__version__ = "0.1.0"
