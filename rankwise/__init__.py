"""rankwise: analytics over per-user ranked preference lists, on Spark.

Operators are plain functions DataFrame -> DataFrame built from Spark SQL
expressions; see ``rankwise.operators`` and ``rankwise.plans.registry``.
"""

__version__ = "0.1.0"
