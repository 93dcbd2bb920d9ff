"""Golden records on Spark: change events from many sources, one canonical table per entity."""

__version__ = "0.1.0"
