"""Column-expression functions: safe casts, date keys, the holiday
calendar and holiday proximity. All are built-in Spark SQL expressions, so
they stay inside whole-stage code generation."""
