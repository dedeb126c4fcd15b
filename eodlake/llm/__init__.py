"""Operators for building language-model training data from the ``documents`` tables.

Nothing else in the package imports this subpackage; ``__spark_entry__`` adds its queries only when it is there.
"""
