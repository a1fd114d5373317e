"""Whole jobs: ledger, builds and releases, derived tables, command line."""
