"""vdjlake: Spark-first analytics for immune-repertoire corpora."""

__version__ = "0.1.0"
