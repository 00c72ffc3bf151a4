"""Spark-native monitoring of text classifiers: data hygiene, evaluation, drift, quality, incidents."""
