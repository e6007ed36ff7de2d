"""FITS image units: headers, shapes and value decoding (FITS standard 4.0)."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import prod

import numpy as np
import pyarrow as pa

from slabwise.functions.types import SPARK_TYPES
from slabwise.schema import ArrayError, ArraySchema, Attr, CorruptFile, Dim, UnsupportedType
from slabwise.sources.files import RangedFile

BLOCK = 2880
CARD = 80

# Fixed values of the format: BITPIX -> big-endian element type.
RAW_TYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
# Fixed value: name given to an image's attribute and array.
UNNAMED = "unknown"


@dataclass
class ImageUnit:
    """One header-data unit."""

    number: int
    cards: list[tuple[str, str | None, str | None]]
    data_start: int
    keys: dict = field(default_factory=dict)

    def get(self, key: str, default=None):
        return self.keys.get(key, default)

    @property
    def axes(self) -> list[int]:
        return [int(self.get(f"NAXIS{i + 1}")) for i in range(int(self.get("NAXIS", 0)))]

    @property
    def bitpix(self) -> int:
        return int(self.get("BITPIX"))

    @property
    def scale(self) -> float:
        return _number(self.get("BSCALE", "1"))

    @property
    def zero(self) -> float:
        return _number(self.get("BZERO", "0"))

    @property
    def pcount(self) -> int:
        return int(self.get("PCOUNT", 0))

    @property
    def gcount(self) -> int:
        return int(self.get("GCOUNT", 1))

    @property
    def kind(self) -> str:
        return "IMAGE" if self.number == 0 else str(self.get("XTENSION", "")).strip()

    @property
    def elements(self) -> int:
        return prod(self.axes) if self.axes else 0

    @property
    def footprint(self) -> int:
        """Data bytes: element bytes x GCOUNT x (elements + PCOUNT)."""
        return abs(self.bitpix) // 8 * self.gcount * (self.elements + self.pcount)

    @property
    def next_start(self) -> int:
        return self.data_start + -(-self.footprint // BLOCK) * BLOCK

    @property
    def value_type(self) -> str:
        return value_type(self.bitpix, self.scale, self.zero)


def _number(text: str) -> float:
    """A header number; the format also allows a D exponent."""
    return float(text.upper().replace("D", "E"))


def value_type(bitpix: int, scale: float, zero: float) -> str:
    """Type of the physical values (same rule as ``functions.fits_type_name``)."""
    if bitpix not in RAW_TYPES:
        raise UnsupportedType(f"BITPIX {bitpix}")
    if scale == 1:
        if bitpix == 8 and zero in (0, -128):
            return "uint8" if zero == 0 else "int8"
        if bitpix > 8 and zero in (0, 2.0 ** (bitpix - 1)):
            return f"int{bitpix}" if zero == 0 else f"uint{bitpix}"
        if bitpix == -32 and zero == 0:
            return "float"
    return "double"


def _parse_card(card: str) -> tuple[str, str | None, str | None]:
    key = card[:8].rstrip()
    if card[8:10] != "= ":
        return key, None, card[8:].strip() or None
    body = card[10:]
    if body.lstrip().startswith("'"):
        at = body.index("'") + 1
        text = ""
        while True:
            quote = body.find("'", at)
            if quote < 0:
                raise CorruptFile(f"unclosed text in card {key}")
            text += body[at:quote]
            if body[quote + 1 : quote + 2] != "'":
                break
            text += "'"
            at = quote + 2
        rest = body[quote + 1 :]
        value = text.rstrip()
    else:
        value, _, rest = body.partition("/")
        rest = "/" + rest
        value = value.strip()
    comment = rest.partition("/")[2].strip()
    return key, value, comment or None


def read_unit(file: RangedFile, number: int, start: int) -> ImageUnit | None:
    """Header of the unit that begins at ``start``; ``None`` at the end of the file."""
    if start >= file.size:
        return None
    cards, at, keys = [], start, {}
    while True:
        if at + BLOCK > file.size:
            if at == start and number > 0:
                return None
            raise CorruptFile(f"{file.path}: header of unit {number} is cut short")
        block = bytes(file.read(at, BLOCK)).decode("ascii", "replace")
        at += BLOCK
        for i in range(0, BLOCK, CARD):
            if block[i : i + 8] == "END     ":
                unit = ImageUnit(number, cards, at, keys)
                if number == 0 and "SIMPLE" not in keys:
                    raise CorruptFile(f"{file.path}: not a FITS file")
                return unit
            if not block[i : i + CARD].strip():
                continue
            card = _parse_card(block[i : i + CARD])
            cards.append(card)
            keys.setdefault(card[0], card[1])
        if number == 0 and "SIMPLE" not in keys:
            raise CorruptFile(f"{file.path}: not a FITS file")


def units(file: RangedFile, limit: int | None = None):
    """Units in file order."""
    number, start = 0, 0
    while limit is None or number < limit:
        unit = read_unit(file, number, start)
        if unit is None:
            return
        yield unit
        number, start = number + 1, unit.next_start


#: Bytes read at once for a box with gaps.
SPAN_BYTES = 32 * 1024 * 1024


class FitsImage:
    """An image unit as an array: axis 1 is ``dim0`` and moves fastest."""

    suffixes = (".fits", ".fit", ".fts")

    def __init__(self, file: RangedFile, options: dict):
        number = int(options.get("hdu", 0))
        unit = next((u for u in units(file, number + 1) if u.number == number), None)
        if unit is None:
            raise ArrayError(f"{file.path}: no unit {number}")
        if unit.kind != "IMAGE":
            raise UnsupportedType(f"{file.path}: unit {number} is a {unit.kind}, not an image")
        if not unit.axes:
            raise UnsupportedType(f"{file.path}: unit {number} holds no array")
        self.file, self.unit = file, unit
        dims = tuple(Dim(f"dim{i}", n) for i, n in enumerate(unit.axes))
        self.schema = ArraySchema(UNNAMED, (Attr(UNNAMED, unit.value_type),), dims)
        # Dimensions from slowest to fastest, the order of the bytes.
        self.file_dims = ArraySchema(UNNAMED, self.schema.attrs, dims[::-1]).planned().dims
        self.columns = [(UNNAMED, SPARK_TYPES[unit.value_type][0])]
        self.raw = self.record = np.dtype(RAW_TYPES[unit.bitpix])
        if unit.data_start + self.raw.itemsize * unit.elements > file.size:
            raise CorruptFile(f"{file.path}: data of unit {number} is cut short")

    def prepare(self, first, last) -> None:
        """Nothing to look up: the data is one piece."""

    def read_box(self, lo, extent):
        """Raw elements of a box, in file order."""
        return read_contiguous(
            self.file, self.unit.data_start, self.raw, [d.size for d in self.file_dims], lo, extent
        )

    def to_arrow(self, raw: np.ndarray, names: list[str]) -> list[pa.Array]:
        """Physical values; BLANK elements of integer images become null."""
        unit, kind = self.unit, self.unit.value_type
        blank = unit.get("BLANK")
        mask = (raw == int(blank)) if blank is not None and unit.bitpix > 0 else None
        if kind == "uint64":
            shifted = raw.astype("i8").view("u8") ^ np.uint64(1 << 63)
            values = pa.array(shifted, mask=mask).cast(pa.decimal128(20, 0))
            return [values]
        if kind in ("float", "double") and unit.scale == 1 and unit.zero == 0:
            values = raw.astype("f4" if kind == "float" else "f8")
        elif kind == "double":
            values = unit.zero + unit.scale * raw.astype("f8")
        else:
            width = SPARK_TYPES[kind][1] * (2 if kind.startswith("u") else 1)
            values = (raw.astype("i8") + int(unit.zero)).astype(f"i{width}")
        return [pa.array(values, mask=mask)]


def read_contiguous(file: RangedFile, start: int, dtype: np.dtype, shape, lo, extent) -> np.ndarray:
    """A box of a row-major array stored in one piece.

    The span that covers the box is read at once and sliced; one longer than
    ``SPAN_BYTES`` is read run by run.
    """
    rank = len(shape)
    strides = [prod(shape[i + 1 :]) for i in range(rank)]
    first = sum(a * s for a, s in zip(lo, strides))
    cells = sum((n - 1) * s for n, s in zip(extent, strides)) + 1
    if cells * dtype.itemsize <= SPAN_BYTES:
        data = np.frombuffer(file.read(start + first * dtype.itemsize, cells * dtype.itemsize), dtype)
        box = np.lib.stride_tricks.as_strided(data, extent, [s * dtype.itemsize for s in strides])
        return box.reshape(-1)
    split = rank
    while split > 0 and extent[split - 1] == shape[split - 1]:
        split -= 1
    split = max(split - 1, 0)  # dimensions from here on form one run
    run = prod(extent[split:])
    pieces = []
    for index in np.ndindex(*extent[:split]):
        offset = sum((lo[i] + index[i]) * strides[i] for i in range(split))
        offset += sum(lo[i] * strides[i] for i in range(split, rank))
        data = file.read(start + offset * dtype.itemsize, run * dtype.itemsize)
        pieces.append(np.frombuffer(data, dtype))
    return pieces[0] if len(pieces) == 1 else np.concatenate(pieces)
