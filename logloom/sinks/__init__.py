"""Sinks: partitioned tables, retention and bulk HTTP writers."""
