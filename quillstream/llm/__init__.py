"""Operators for preparing training data at corpus scale.

Nothing else in the library imports this subpackage; ``queries.py`` registers
one query per operator and ``corpus_pipeline.py`` (repository top) chains them.
"""
