"""Operators for preparing training text, their queries and the SQL that checks them."""
