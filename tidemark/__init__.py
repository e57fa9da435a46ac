"""tidemark: a Spark-native analytics engine for message streams and text corpora."""

__version__ = "0.1.0"
