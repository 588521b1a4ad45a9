"""The registered queries and, for each, the same result as plain SQL.

``QUERIES`` maps a name to a function of (spark, folder of the given tables); ``ORACLES`` maps
the name to SQL over views of those tables.
"""

from dqspark.registry import alerting, checks, faults, monitoring, profiling, streams, suites, tables

_PARTS = (tables, checks, suites, profiling, monitoring, alerting, faults, streams)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
