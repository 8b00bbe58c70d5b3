"""DataFrame operators over the ledger tables."""
