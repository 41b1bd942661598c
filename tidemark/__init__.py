"""Tidemark: capture, typed storage and time-window queries of market tick data, as Spark plans."""
