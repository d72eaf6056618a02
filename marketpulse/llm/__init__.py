"""Operators of a training-data pipeline over the ``documents`` and
``conversations`` tables. Nothing else in the library imports this subpackage."""
