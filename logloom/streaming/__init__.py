"""logloom streaming package."""
