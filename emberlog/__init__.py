"""emberlog: firewall and network-device log analytics on Spark.

Layers: ``functions`` (Column expressions), ``sources`` (readers, writers,
topic logs, the driver-table bridge), ``operators`` (parsers, routing,
bronze/silver/gold, serving loads, views), ``plans`` (multi-stage jobs),
``streaming`` (Structured Streaming ingest and serving).
"""

__version__ = "0.1.0"
