"""Registered queries, each with the SQL that states its result."""
