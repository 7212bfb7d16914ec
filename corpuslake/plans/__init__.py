"""End-to-end plans and the registry of checked queries."""
