"""Structured Streaming: landing files to bronze, de-duplication, rollups by business window."""
