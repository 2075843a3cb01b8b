"""Operators for preparing training data: ten corpus operators and their queries.

Nothing outside this package imports it.  Every module holds one operator with its
own interface; ``entries`` holds the registered queries and their SQL.
"""
