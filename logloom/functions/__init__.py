"""logloom functions package."""
