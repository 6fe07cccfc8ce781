"""Reading feeds and tables, and writing tables."""
