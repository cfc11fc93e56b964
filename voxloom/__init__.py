"""Spark-native analytics for sparse voxel volumes, their segments and the edges between them."""
