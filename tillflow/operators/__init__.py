"""Transformations from frames to frames. None of them reads or writes a table; clocks come in as arguments."""
