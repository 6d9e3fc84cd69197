"""Touchline: a PySpark-native scouting-analytics library."""
