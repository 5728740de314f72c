"""Every operator as a named query over the given tables, with the SQL it is checked against."""
