"""The three jobs end to end, and the registry of checked queries."""
