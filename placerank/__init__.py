"""placerank: text-and-catalogue analytics as lazy Spark DataFrame operators.

Sub-packages: ``sources`` (readers, sinks, test-table bindings), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame analyses), ``plans`` (named queries,
oracle SQL, plan inspection), ``streaming`` (the counting operators over a stream).
"""

__version__ = "0.1.0"
