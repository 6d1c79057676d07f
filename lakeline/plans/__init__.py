"""Compositions of operators: model graph, pipeline, consumer queries, oracle SQL."""
