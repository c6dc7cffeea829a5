"""Operators of a training-data pipeline over documents and embeddings.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports
it.  Import the operator modules themselves.
"""
