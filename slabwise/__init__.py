"""Scientific arrays on Spark: scan array files, reshape, slice, aggregate, store."""

from slabwise.schema import (
    ArrayError,
    ArraySchema,
    Attr,
    BadBounds,
    CorruptFile,
    Dim,
    UnsupportedType,
    chunk_plan,
)
from slabwise.session import build_session, scratch_dir

__all__ = [
    "ArrayError",
    "ArraySchema",
    "Attr",
    "BadBounds",
    "CorruptFile",
    "Dim",
    "UnsupportedType",
    "build_session",
    "chunk_plan",
    "scratch_dir",
]
