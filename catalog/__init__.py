"""Driver queries: each operator on the given tables, with the SQL that must agree with it."""
