"""Job chains, the SQL serving surface, and the registry of checked queries."""
