"""Spark-native abstraction of biomedical literature into reviewed clinical variables."""
