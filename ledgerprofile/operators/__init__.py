"""Operators: summaries, series statistics, trade-graph algebra, ranking."""
