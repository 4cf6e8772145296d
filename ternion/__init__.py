"""Spark-native knowledge-graph analytics: sources, operators, plans and functions over DataFrames."""
