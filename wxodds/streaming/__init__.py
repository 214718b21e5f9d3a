"""Structured Streaming jobs built from the batch operators' stateless functions plus three
stateful processors (as-of weather, accuracy baseline, price-change cache)."""
