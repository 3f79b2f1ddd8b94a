"""Operators that prepare training text: counting, cleaning, joining, formatting and packing.

Nothing else in the library imports this package; ``queries`` holds its registered queries.
"""
