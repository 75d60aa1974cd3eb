"""Checks of the operators on the given tables: each a Spark query and the SQL that says the same."""
