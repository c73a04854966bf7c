"""Registered queries over the driver tables, each with its reference SQL."""

from scopewise.queries.catalog import QUERIES

__all__ = ["QUERIES"]
