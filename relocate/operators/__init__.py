"""Operators: selection, predicates, assignment, metrics, reconciliation, staging, loading, ledger."""
