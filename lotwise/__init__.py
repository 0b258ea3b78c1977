"""Listing analytics as Spark DataFrame operators: profile, clean, model, score."""
