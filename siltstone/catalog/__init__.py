"""The queries of ``__spark_entry__.py``, each beside the SQL it must equal."""

from siltstone.catalog import grouping, landing, loads, merging, quality, versions

MODULES = (landing, quality, grouping, merging, versions, loads)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

__all__ = ["ORACLES", "QUERIES"]
