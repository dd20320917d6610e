"""Training-data operators: each is a function from DataFrames to DataFrames.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
