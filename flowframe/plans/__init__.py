"""Catalog of registered queries: one Spark query plus one DuckDB oracle per
inventory row.  Importing :mod:`flowframe.plans.catalog` fills the registry."""
