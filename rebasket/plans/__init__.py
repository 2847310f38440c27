"""Composed jobs, and the registered queries."""
