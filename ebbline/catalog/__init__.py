"""Every operator as a query over the generated tables, with the SQL it must equal."""
