"""Column expressions. All are built-in Spark expressions: no UDF, whole-stage codegen stays on."""
