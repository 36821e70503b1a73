"""Statement files to trusted analytics tables, as Spark DataFrame operators."""

__version__ = "0.1.0"
