"""vetrow: published survey files turned into trusted tables, as Spark jobs.

Layers: ``sources`` (discover, audit, ingest), ``operators`` (contract,
duplicates, quarantine, quality rules, marts, tables), ``plans`` (the ordered
bronze/silver/gold runs and the registered queries), ``streaming`` (ingestion
as files land).
"""

__version__ = "0.1.0"
