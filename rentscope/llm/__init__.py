"""Operators of a training-data pipeline (documents, pages, conversations).

Nothing else in the library imports this subpackage; its queries are listed in
``rentscope.llm.catalog``.
"""
