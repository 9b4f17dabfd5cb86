"""quakehouse: a hazard-event warehouse built on Spark DataFrames.

Subpackages: ``functions`` (Column expressions), ``sources`` (readers and
sinks), ``operators`` (keys, dimensions, lookups, facts, bridge, nearest
place, ingest, quality), ``plans`` (the derived warehouse, the whole load and
the registered queries), ``streaming`` (incremental landing ingest).
"""

__version__ = "0.1.0"
