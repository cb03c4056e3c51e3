"""Files and named tables, read and written."""
