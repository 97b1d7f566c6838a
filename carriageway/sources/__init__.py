"""Reading and writing tables, files and feeds."""
