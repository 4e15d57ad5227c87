"""gridcat: gridded-data and catalog operators as Spark DataFrame transformations."""

__version__ = "0.1.0"
