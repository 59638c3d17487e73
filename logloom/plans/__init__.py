"""logloom plans package."""
