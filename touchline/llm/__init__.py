"""Operators for building training corpora.

Nothing else in ``touchline`` imports this subpackage; it can be deleted with
``tests/llm`` and ``corpus_pipeline.py`` and the rest still works.
"""
