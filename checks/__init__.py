"""Queries over the given tables that prove each operator, with SQL restatements."""
