"""Registered queries: the operators over the given tables, and the SQL that checks them."""
