"""Column expressions.

All are built-in Spark SQL expressions, written as SQL text: one text becomes a column in
a single call, and plans with hundreds of expressions are built in no time.  There are no
UDFs.  Arguments are SQL texts, usually column names.
"""
