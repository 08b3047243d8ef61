"""Spark-native engine that builds and analyses a corpus of web articles."""
