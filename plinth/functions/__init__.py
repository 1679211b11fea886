"""Column-expression helpers: everything here is a Catalyst expression."""
