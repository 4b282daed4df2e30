"""Operators of a training-data pipeline. Nothing else in the library imports
this package; its queries and their SQL are in `queries` and `sql`."""
