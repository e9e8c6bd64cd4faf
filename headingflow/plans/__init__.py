"""Whole flows, the derived tables and the registered queries."""
