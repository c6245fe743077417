"""eventlake: a Spark-native event-lake analytics engine.

Layers (all pure DataFrame -> DataFrame transforms unless noted):

- ``sources``   raw JSON-line scans, hour-slot addressing, dimension snapshots,
                fixtures derived from the driver tables
- ``functions`` column-expression helpers (JSON extraction, legacy casts,
                conditional counts, record hash)
- ``operators`` bronze / silver / gold / SCD2 / data quality / ranking / serving
- ``sinks``     key-merge, day-replace, versioned-overwrite and compaction writers
- ``plans``     batch jobs that chain the layers with quality gates
- ``streaming`` Structured Streaming ingestion on the same transforms
"""

__version__ = "0.1.0"
