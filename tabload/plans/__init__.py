"""Whole jobs: cleaning chain, submission load, reference-data refresh."""
