"""Operators over DataFrames: ``cleanse`` (C1-C12), ``load`` (staged
warehouse loads), ``tenants`` (registry, tagging, central merge), ``audit``
(keys, foreign keys, lengths, conformance), ``calendar``, ``hierarchy``,
``lookup`` (interval and label lookups), ``skew`` (skew-safe fan-out
joins)."""
