"""Column functions: each takes columns and returns one column, all inside whole-stage codegen."""
