"""Ranking, batching, landing, merging, ledgers and reports over DataFrames."""
