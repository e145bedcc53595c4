"""Operators for training-data pipelines over a corpus of documents or pages.

Nothing outside this subpackage imports it.
"""
