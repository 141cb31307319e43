"""corpusloom: concepts, statistics and graphs from free-text records, on Spark.

Subpackages: ``sources`` (reading and writing), ``functions`` (column
expressions), ``operators`` (DataFrame operators), ``plans`` (whole pipelines),
``streaming`` (incremental forms), ``queries`` (named queries and their SQL).
"""

__version__ = "1.0.0"
