"""Scalar functions as Spark SQL text.

Each function takes the SQL text of its inputs (usually a column name) and
returns the SQL text of the result, for ``selectExpr`` or ``F.expr``. Everything
is built in, so it stays inside whole-stage code generation.
"""
