"""Spark-native analytics for stacks of complex samples on a grid."""
