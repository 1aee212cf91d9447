"""Operators of a training-data pipeline over the ``documents`` and
``embeddings`` tables.

One module per operator; ``queries`` registers them. Every operator takes a
DataFrame, reads only the columns it names (extra columns, whatever they are
called, are ignored) and returns its own columns keyed by the row id.
Nothing outside this package imports it.
"""
