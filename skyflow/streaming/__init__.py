"""Streaming sinks, jobs, monitoring and the one stateful operator."""
