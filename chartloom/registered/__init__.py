"""Queries over the test tables, each next to the SQL that states its expected result."""
