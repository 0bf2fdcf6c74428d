"""Every operator and job as a named query over a data folder, with the SQL it has to agree with."""

from tallyloom.catalog import aggregates, columns, jobs, joins, reshaping, rows, scalars, sinks, sources  # noqa: F401
from tallyloom.catalog.registry import oracles, queries  # noqa: F401
