"""Reading messages and files, writing tables."""
