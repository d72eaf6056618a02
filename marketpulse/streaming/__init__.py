"""Structured Streaming jobs, micro-batch sinks and stateful cooldown."""
