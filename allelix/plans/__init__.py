"""Registered queries: each applies an operator to the given tables, with the SQL that says the same."""
