"""logloom sources package."""
