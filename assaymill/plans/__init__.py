"""Whole flows: silver and gold jobs, and the registry of named queries."""
