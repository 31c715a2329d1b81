"""Source tables, client lookups, ledger documents and the sample vault."""
