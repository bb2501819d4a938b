"""tessera: a Spark-native engine for instruction-tuning and preference datasets."""

__version__ = "0.1.0"
