"""Sinks: staged, validated and published snapshots, and the run log."""
