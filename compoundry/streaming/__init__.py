"""The request worker as a Structured Streaming job."""
