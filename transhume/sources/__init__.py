"""Reading and writing tables, column lists and table dumps."""
