"""goldrec: golden records from many overlapping sources, as Spark jobs."""

__version__ = "0.1.0"
