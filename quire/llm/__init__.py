"""Operators of a training-data pipeline over document tables.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``registry`` binds them to production queries.
"""
