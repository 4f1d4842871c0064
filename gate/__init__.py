"""The operators exercised on the test tables, each beside the SQL it must agree with."""
