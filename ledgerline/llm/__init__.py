"""Operators for large training corpora.

Each module holds one operator with a general interface; ``queries`` registers
one query per operator and the corpus pipeline.  Nothing else in the library
imports this subpackage.
"""
