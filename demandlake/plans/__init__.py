"""End-to-end plans: input derivation from the given tables, ingest, catalog."""
