"""The recorder: polled order books as a Structured Streaming source."""
