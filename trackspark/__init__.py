"""Spark-native analytics over GPS trajectories."""
