"""Operators for preparing language-model training data.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
:mod:`adevents.llm.queries` registers the queries, :mod:`adevents.llm.oracles`
their SQL.
"""
