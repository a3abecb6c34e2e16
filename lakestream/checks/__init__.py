"""Every operator as a query over the test tables, with the SQL it must agree with."""
