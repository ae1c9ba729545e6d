"""Streaming and batch text annotation of forum items, written as Spark DataFrame operators."""
