"""Every operator as a query over the test tables, and its statement in plain SQL."""
