"""Joins, graph, sampling, model and evaluation operators."""
