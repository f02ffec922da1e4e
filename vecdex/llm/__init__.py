"""Operators for preparing language-model training data.

One module per operator; ``registry`` lists their queries and SQL. Nothing
outside this package imports it, except the guarded lookup in
``__spark_entry__`` and ``corpus_pipeline``.
"""
