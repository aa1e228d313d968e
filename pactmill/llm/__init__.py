"""Operators for large training corpora, their registered queries and the SQL these are checked against."""
