"""Verbarium: a Spark-first engine for multilingual vocabulary and learner progress."""
