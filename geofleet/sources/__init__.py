"""Inputs: the driver's parquet tables, the fixture views derived from them,
the change-feed reader and streaming file sources."""

from geofleet.sources.tables import read_table, table_path  # noqa: F401
