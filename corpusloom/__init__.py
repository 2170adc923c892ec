"""corpusloom: a Spark-native engine for curating text corpora."""

__version__ = "0.1.0"
