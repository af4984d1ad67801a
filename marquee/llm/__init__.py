"""Operators for preparing training data from documents and web pages.

Nothing else in the library imports this subpackage. ``queries`` and ``oracle_sql``
are read by the driver entry point.
"""
