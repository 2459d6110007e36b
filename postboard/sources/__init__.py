"""Feed payloads, landing tables and configuration tables."""
