"""File-stream ingest."""
