"""Whole steps: operators put together, with their sources and sinks."""
