"""corpusloom: Spark-native preparation of text corpora for model training."""

__version__ = "0.1.0"
