"""The operators as named queries over the given tables, with SQL to check them."""
