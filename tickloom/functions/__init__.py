"""Null-safe column expressions and label rules."""
