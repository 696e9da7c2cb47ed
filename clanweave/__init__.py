"""Similarity networks, gene neighbourhoods and marker abundance as Spark DataFrame operations."""
