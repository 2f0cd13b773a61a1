"""Every operator as a query over the given tables, with the same question in SQL."""
