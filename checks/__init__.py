"""Test bed: the generic driver tables dressed up as work-order tables, queries and oracles."""
