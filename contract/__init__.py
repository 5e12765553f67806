"""Queries on the test tables with their SQL counterparts."""
