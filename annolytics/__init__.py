"""Annotation and retrieval-evaluation analytics as lazy Spark DataFrame plans."""
