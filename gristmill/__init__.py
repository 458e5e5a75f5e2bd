"""gristmill: a Spark-native engine for curating large text corpora."""
