"""The batch semantics as Structured Streaming."""
