"""Pipelines composed from the operators, plus test-table adapters."""
