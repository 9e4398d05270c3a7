"""Analytical marts, serving queries and run-record summaries."""
