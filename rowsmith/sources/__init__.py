"""Reading and writing tables, reports and control files."""
