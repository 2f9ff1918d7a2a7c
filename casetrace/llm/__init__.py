"""Operators of a training-data pipeline: shard, filter, de-duplicate,
decontaminate, tokenise, index, pack, score and format text at scale.

Nothing outside this folder imports it.  ``queries.py`` holds the registered
queries with their DuckDB twins.
"""
