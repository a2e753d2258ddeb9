"""clinark — clinical-records analytics on Spark DataFrames.

Tiers: raw FHIR resources (``sources``) → clean tables (``operators.normalize``)
→ gold aggregates (``operators.gold``) → serving queries (``operators.serving``,
with top-k and pages from ``operators.ranking``); batch jobs and the load audit in
``plans``, the routing ingest in ``streaming``.
"""

__version__ = "0.1.0"
