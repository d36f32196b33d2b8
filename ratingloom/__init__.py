"""Ratings, catalogue and tag analytics plus rating prediction, as Spark DataFrame operators."""
