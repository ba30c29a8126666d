"""Composed jobs: lake tables, the three layers, fixtures and the registered queries."""
