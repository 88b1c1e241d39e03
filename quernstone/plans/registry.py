"""All queries of the general part, with the SQL that checks each."""

from quernstone.plans import aggregates, graphs, joins, patterns, ranges, relational, scalars, segments, sets, sinks, streams, surface, vectors, windows  # noqa: F401
from quernstone.plans.catalog import ORACLE_SQL, QUERIES  # noqa: F401
