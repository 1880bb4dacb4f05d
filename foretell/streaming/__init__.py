"""Structured Streaming jobs; each builder takes and returns DataFrames."""
