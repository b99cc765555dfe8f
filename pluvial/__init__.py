"""pluvial: clinical records x daily weather analytics on Spark.

Layers (all functions take and return DataFrames; nothing is collected):

- ``pluvial.sources``   raw inputs: derived raw tables, FHIR bundle scan,
                         weather landing, code-hierarchy flattening
- ``pluvial.functions`` column expressions (ages, durations, categories, JSON paths)
- ``pluvial.operators`` upserts, data-quality checks, joins, top-k, statistics
- ``pluvial.plans``     staging -> intermediate -> marts -> KPI models
- ``pluvial.streaming`` incremental landing with Structured Streaming
"""

__version__ = "0.1.0"
