"""Quarrylake: a PySpark-native batch analytics library for heterogeneous feeds."""
