"""Change events, app logs and dimension feeds derived from order and event tables.

They give the warehouse its kind of input at the size of the given tables.  All
rules are per row; a line number that occurs twice in an order gives two versions
of one detail.
"""
