"""Table schemas, readers, writers and the adapter for commerce test tables."""
