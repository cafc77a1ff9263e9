"""Operators of a training-data pipeline over large text corpora.

Nothing else in the library imports this subpackage; the registered queries and their SQL are in
:mod:`depreco.llm.catalog`.
"""
