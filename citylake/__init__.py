"""citylake: Spark DataFrame operators and plans for a city open-data lake.

Subpackages: ``sources`` (landing documents, zones, JDBC), ``operators`` (structure, dedup,
reconcile, rank, aggregate, upsert, quality), ``functions`` (column helpers), ``plans`` (marts,
dashboard, features, model, the city configuration), ``streaming``.
"""

__version__ = "0.1.0"
