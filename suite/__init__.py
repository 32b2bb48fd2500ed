"""Queries over the supplied tables, each beside the SQL that checks it."""
