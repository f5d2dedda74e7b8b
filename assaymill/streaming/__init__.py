"""Structured Streaming: sources, raw log, late data, unified batch and stream view."""
