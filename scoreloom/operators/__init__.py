"""Operators: DataFrame in, DataFrame (or a scalar-subquery Column) out."""
