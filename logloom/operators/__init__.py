"""logloom operators package."""
