"""Composite queries, jobs and the query registry."""
