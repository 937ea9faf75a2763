"""Mart views, portal reports and the named queries."""
