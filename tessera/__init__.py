"""Tessera: a Spark-native text and record-linkage analytics engine."""
