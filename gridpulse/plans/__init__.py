"""Chained jobs and registered queries."""
