"""Operators: cleaning, rules, features, as-of joins, drift, quantiles, models."""
