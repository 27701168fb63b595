"""Operators on tables: profile, validate, derive, fit, split, classify, evaluate."""
