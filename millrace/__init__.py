"""Spark-native analytics over public registers: graph, corpus, quality and training-data operators."""
