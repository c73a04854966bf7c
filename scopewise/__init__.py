"""Scoped aggregate statistics on Spark DataFrames.

A *fact* holds one row per entity inside a scope, with category counts and
their total.  The package proves the quality of such facts, classifies
duplicate keys, ranks entities inside every scope, answers dashboard queries
and publishes releases that can be verified later.
"""

from scopewise.spec import DEFAULT_SPEC, DataQualityError, FactSpec

__all__ = ["DEFAULT_SPEC", "DataQualityError", "FactSpec"]
