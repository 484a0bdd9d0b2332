"""Where frames come from and where they go: landing files, reference files, tables."""
