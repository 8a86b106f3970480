"""The sources and cleaning steps on a Structured Streaming input."""
