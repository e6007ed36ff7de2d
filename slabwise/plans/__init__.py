"""Registered queries, by subject."""

from slabwise.plans import (  # noqa: F401  (imported for their registrations)
    array_queries,
    file_queries,
    frame_queries,
    nested_queries,
    slab_queries,
    text_queries,
    type_queries,
)
from slabwise.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
