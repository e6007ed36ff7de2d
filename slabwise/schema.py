"""Array description: named dimensions, named attributes and a chunk plan.

A DataFrame in *cells* layout has one LONG column per dimension and one column
per attribute.  In *slabs* layout it has one row per chunk: ``slab_no``,
``origin_<dim>`` and ``last_<dim>`` columns plus one array column per attribute,
values in row-major order (last dimension fastest).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace
from math import prod

from pyspark.sql import DataFrame, functions as F

# Fixed values of the array model.
CHUNK_CELLS = 1024 * 1024
UNLIMITED = 2**63 - 1
METADATA_KEY = "array"


class ArrayError(ValueError):
    """Base of every error this package raises on purpose."""


class UnsupportedType(ArrayError):
    """The file holds a type that has no array form."""


class CorruptFile(ArrayError):
    """The file is truncated or is not of the expected format."""


class BadBounds(ArrayError):
    """A slice lies outside the array."""


@dataclass(frozen=True)
class Dim:
    """One dimension: ``size`` cells from 0, growable up to ``limit`` cells."""

    name: str
    size: int
    chunk: int | None = None
    limit: int | None = None  # None: no growth; UNLIMITED: extendable
    inside: bool = False  # belongs to the element, not to the dataset
    overlap: int = 0

    @property
    def end(self) -> int:
        return self.size - 1

    @property
    def max(self) -> int:
        if self.limit is None:
            return self.size - 1
        return UNLIMITED if self.limit >= UNLIMITED else self.limit - 1

    @property
    def step(self) -> int:
        return self.chunk if self.chunk is not None else self.size


@dataclass(frozen=True)
class Attr:
    name: str
    type: str


@dataclass(frozen=True)
class ArraySchema:
    name: str
    attrs: tuple[Attr, ...]
    dims: tuple[Dim, ...]
    first_fastest: bool = False  # how cells lie in a slab: by default the last dimension moves fastest

    @property
    def rank(self) -> int:
        return len(self.dims)

    @property
    def shape(self) -> tuple[int, ...]:
        return tuple(d.size for d in self.dims)

    @property
    def chunks(self) -> tuple[int, ...]:
        return tuple(d.step for d in self.dims)

    @property
    def dim_names(self) -> list[str]:
        return [d.name for d in self.dims]

    @property
    def slowest_first(self) -> list[str]:
        """Dimension names in the order in which cells lie in a slab."""
        return self.dim_names[::-1] if self.first_fastest else self.dim_names

    @property
    def attr_names(self) -> list[str]:
        return [a.name for a in self.attrs]

    @property
    def cell_count(self) -> int:
        return prod(self.shape)

    def with_chunks(self, chunks) -> "ArraySchema":
        return replace(
            self, dims=tuple(replace(d, chunk=c) for d, c in zip(self.dims, chunks, strict=True))
        )

    def planned(self, threshold: int = CHUNK_CELLS) -> "ArraySchema":
        """The same array with the default chunk plan."""
        inside = sum(d.inside for d in self.dims)
        return self.with_chunks(chunk_plan(self.shape, threshold, inside))

    def show(self) -> str:
        """Schema text, e.g. ``t<s:uint32 NOT NULL> [unnamed0=0:9,10,0]``."""
        attrs = ",".join(f"{a.name}:{a.type} NOT NULL" for a in self.attrs)
        dims = ",".join(f"{d.name}=0:{d.max},{d.step},{d.overlap}" for d in self.dims)
        return f"{self.name}<{attrs}> [{dims}]"

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "ArraySchema":
        raw = json.loads(text)
        return ArraySchema(
            raw["name"],
            tuple(Attr(**a) for a in raw["attrs"]),
            tuple(Dim(**d) for d in raw["dims"]),
            raw.get("first_fastest", False),
        )

    def attach(self, df: DataFrame) -> DataFrame:
        """Keep this description in the metadata of the first column.

        Spark writes column metadata into Parquet footers, so a stored array
        finds its description again without a side file.
        """
        first = df.columns[0]
        return df.withMetadata(first, {METADATA_KEY: self.to_json()})

    @staticmethod
    def of(df: DataFrame) -> "ArraySchema":
        for field in df.schema.fields:
            if METADATA_KEY in field.metadata:
                return ArraySchema.from_json(field.metadata[METADATA_KEY])
        raise ArrayError("no array description in the column metadata")


def chunk_plan(shape, threshold: int = CHUNK_CELLS, inside: int = 0) -> tuple[int, ...]:
    """Chunk lengths for a shape, from the fastest (last) dimension backwards.

    A dimension keeps its full extent while the running cell count stays within
    ``threshold``; beyond it the length is 1 and the running count is kept.  The
    last ``inside`` dimensions belong to the element and are never split.  A
    fastest dimension that alone exceeds the threshold is cut at the threshold.
    """
    outer, inner = list(shape[: len(shape) - inside]), list(shape[len(shape) - inside :])
    cells = prod(inner) if inner else 0
    plan = []
    for position, size in enumerate(reversed(outer)):
        grown = cells * size or size
        if grown <= threshold:
            plan.append(size)
            cells = grown
        elif position == 0 and not inner:
            plan.append(threshold)
            cells = threshold
        else:
            plan.append(1)
    return tuple(reversed(plan)) + tuple(inner)


def chunk_plan_column(dims, threshold: int = CHUNK_CELLS):
    """The same plan as a Column over an ``array<bigint>`` of extents."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("cells"),
        F.array().cast("array<bigint>").alias("plan"),
    )

    def step(acc, size):
        product = acc["cells"] * size
        grown = F.when(product == 0, size).otherwise(product)
        fastest = F.size(acc["plan"]) == 0
        fits = grown <= threshold
        cut = F.when(fastest, F.lit(threshold)).otherwise(F.lit(1)).cast("bigint")
        length = F.when(fits, size).otherwise(cut)
        cells = F.when(fits, grown).when(fastest, F.lit(threshold)).otherwise(acc["cells"])
        return F.struct(
            cells.cast("bigint").alias("cells"),
            F.concat(F.array(length), acc["plan"]).alias("plan"),
        )

    return F.aggregate(F.reverse(dims), start, step, lambda acc: acc["plan"])
