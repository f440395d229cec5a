"""Operators for building training data: each module holds one of them.

``queries`` registers them on the shared tables, ``sql`` holds the SQL of those
that SQL can express. Nothing else in the library imports this package.
"""
