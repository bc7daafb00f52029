"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing outside this package imports it; its queries and their SQL are in
``paylake.llm.queries``.
"""
