"""Ledger tie-out on Spark: contracts, quarantine, reconciliation, scorecards."""
