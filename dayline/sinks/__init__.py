"""Writing tables, and the table that results from changing rows."""
