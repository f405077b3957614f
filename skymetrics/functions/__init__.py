"""Column-level helpers: every function returns a ``Column`` built from
built-in Spark expressions, so they stay inside whole-stage codegen."""
