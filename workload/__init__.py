"""The library's operators as queries over the test tables, with SQL to compare."""
