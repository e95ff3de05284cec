"""tessera — Spark DataFrame operators for counting, pairwise distance,
k-center diversity and weighted k-median clustering."""

__version__ = "0.1.0"
