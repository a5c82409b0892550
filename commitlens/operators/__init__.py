"""Batch operators: commit questions, lineage, graph, statistics, logs, text and ordered sequences."""
