"""The library's operators as queries over the given tables, with the SQL each must agree with."""
