"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage.  ``registry`` lists the
queries (and, where SQL can express them, their SQL).
"""
