"""Operators: DataFrame in, DataFrame out; no actions, no I/O."""
