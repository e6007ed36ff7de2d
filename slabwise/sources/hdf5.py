"""HDF5 metadata and element decoding for the subset the loader needs.

Follows the public HDF5 File Format Specification: superblock 0/1, version 1
object headers, symbol-table groups; integer, float, string, compound, enum,
variable-length and array types; compact, contiguous and (version 1 B-tree)
chunked layouts; deflate and shuffle filters.  Anything else is named in an
``UnsupportedType`` error.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field
from itertools import islice
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from slabwise.functions.types import SPARK_TYPES, TYPE_CLASSES
from slabwise.schema import (
    CHUNK_CELLS,
    UNLIMITED,
    ArrayError,
    ArraySchema,
    Attr,
    CorruptFile,
    Dim,
    UnsupportedType,
    chunk_plan,
)
from slabwise.sources.files import RangedFile
from slabwise.sources.fits import read_contiguous

# Fixed values of the format.
SIGNATURE = b"\x89HDF\r\n\x1a\n"
MSG_DATASPACE, MSG_DATATYPE, MSG_FILL, MSG_LAYOUT = 0x01, 0x03, 0x05, 0x08
MSG_EXTERNAL, MSG_FILTERS, MSG_CONTINUATION, MSG_SYMBOL_TABLE = 0x07, 0x0B, 0x10, 0x11
FILTER_DEFLATE, FILTER_SHUFFLE = 1, 2
KNOWN_FILTERS = {FILTER_DEFLATE, FILTER_SHUFFLE}
STRING_PADDING = {0: "nullterm", 1: "nullpad", 2: "spacepad"}

# A task decodes at most this much of a dataset at once.
READ_BYTES = 64 * 1024 * 1024
VARIABLE_CELLS = 4096


# Bytes of a member's name that are read at first, and gaps between names that are read over.
NAME_BYTES = 64
NAME_GAP = 4096


@dataclass
class ElementType:
    """A datatype message: its class, size and parts."""

    class_code: int
    size: int
    signed: bool = True
    order: str = "<"
    padding: str = ""
    variable_string: bool = False
    members: list = field(default_factory=list)  # compound: (name, offset, ElementType)
    labels: list = field(default_factory=list)  # enum: (name, code)
    base: "ElementType | None" = None
    shape: tuple = ()

    @property
    def class_name(self) -> str:
        return TYPE_CLASSES.get(self.class_code, "UNKNOWN")

    @property
    def type_name(self) -> str:
        """Array type name of a simple element (empty for others)."""
        if self.class_name == "INTEGER":
            return f"{'' if self.signed else 'u'}int{self.size * 8}"
        if self.class_name == "FLOAT":
            return {2: "float16", 4: "float", 8: "double"}.get(self.size, f"float{self.size * 8}")
        if self.class_name == "ENUM":
            return self.base.type_name
        return "string" if self.class_name == "STRING" else ""

    @property
    def ddl_name(self) -> str:
        """Type name in the text dump."""
        if self.class_name == "STRING":
            return f"CHAR[{self.size}]"
        name = self.type_name
        return {"int64": "LONG", "uint64": "ULONG"}.get(name, name.upper())

    @property
    def has_variable_length(self) -> bool:
        parts = [m[2] for m in self.members] + ([self.base] if self.base else [])
        return self.class_name == "VLEN" or any(p.has_variable_length for p in parts)

    def numpy(self) -> np.dtype:
        kind = self.class_name
        if kind in ("INTEGER", "ENUM"):
            letter = "i" if self.signed else "u"
            return np.dtype(f"{self.order}{letter}{self.size}")
        if kind == "FLOAT":
            if self.size not in (2, 4, 8):
                raise UnsupportedType(f"float of {self.size} bytes")
            return np.dtype(f"{self.order}f{self.size}")
        if kind == "STRING":
            return np.dtype(f"V{self.size}")
        if kind == "ARRAY":
            return np.dtype((self.base.numpy(), self.shape))
        if kind == "COMPOUND":
            return np.dtype(
                {
                    "names": [m[0] for m in self.members],
                    "formats": [m[2].numpy() for m in self.members],
                    "offsets": [m[1] for m in self.members],
                    "itemsize": self.size,
                }
            )
        if kind == "VLEN":
            return np.dtype([("count", "<u4"), ("heap", "<u8"), ("index", "<u4")])
        raise UnsupportedType(f"element class {kind}")

    def spark(self):
        """Spark type of one element."""
        kind = self.class_name
        if kind in ("INTEGER", "FLOAT", "ENUM"):
            if self.type_name not in SPARK_TYPES:
                raise UnsupportedType(f"element type {self.type_name}")
            return SPARK_TYPES[self.type_name][0]
        if kind == "STRING" or self.variable_string:
            return StringType()
        if kind in ("ARRAY", "VLEN"):
            return ArrayType(self.base.spark())
        if kind == "COMPOUND":
            return StructType([StructField(n, t.spark()) for n, _, t in self.members])
        raise UnsupportedType(f"element class {kind}")


@dataclass
class Header:
    """What a dataset's object header says."""

    element: ElementType | None = None
    shape: tuple | None = None
    limits: tuple = ()
    layout: tuple = ()
    filters: list = field(default_factory=list)
    fill: bytes | None = None
    group: tuple | None = None  # (B-tree address, heap address)

    @property
    def kind(self) -> str:
        if self.group is not None:
            return "group"
        return "dataset" if self.element is not None and self.shape is not None else "other"


class Hdf5File:
    def __init__(self, file: RangedFile):
        self.file = file
        # The superblock lies at 0 or, behind a user block, at 512 and its doublings.
        start = 0
        while start + 96 <= file.size and file.read(start, 8) != SIGNATURE:
            start = start * 2 or 512
        if start + 96 > file.size:
            start = None
        if start is None:
            raise CorruptFile(f"{file.path}: not an HDF5 file")
        head = bytes(file.read(start, 24))
        version = head[8]
        if version > 1:
            raise UnsupportedType(f"{file.path}: superblock version {version}")
        if head[13] != 8 or head[14] != 8:
            raise UnsupportedType(f"{file.path}: offsets of {head[13]} bytes")
        fields = start + 24 + (4 if version == 1 else 0)
        self.base, *_ = struct.unpack("<Q", file.read(fields, 8))
        self.root, *_ = struct.unpack("<Q", file.read(fields + 40, 8))
        self._heaps: dict[int, dict[int, bytes]] = {}
        self._names: dict[int, tuple[int, int]] = {}  # the last group's heap: where its names lie, and their bytes

    def read(self, address: int, length: int) -> bytes:
        return bytes(self.file.read(self.base + address, length))

    # Object headers

    def header(self, address: int) -> Header:
        if address == UNDEFINED:
            raise UnsupportedType(f"{self.file.path}: soft link")
        version, _, count, _, size = struct.unpack("<BBHII", self.read(address, 12))
        if version != 1:
            raise UnsupportedType(f"{self.file.path}: object header version {version}")
        head, blocks = Header(), [(address + 16, size)]
        seen = 0
        while blocks:
            at, length = blocks.pop(0)
            data, pos = self.read(at, length), 0
            while pos + 8 <= length and seen < count:
                kind, size, flags = struct.unpack_from("<HHB", data, pos)
                body = data[pos + 8 : pos + 8 + size]
                pos, seen = pos + 8 + size, seen + 1
                if kind == MSG_CONTINUATION:
                    blocks.append(struct.unpack_from("<QQ", body))
                elif kind == MSG_SYMBOL_TABLE:
                    head.group = struct.unpack_from("<QQ", body)
                elif kind == MSG_DATATYPE:
                    if flags & 2:
                        raise UnsupportedType(f"{self.file.path}: shared datatype")
                    head.element, _ = parse_type(body, 0)
                elif kind == MSG_DATASPACE:
                    head.shape, head.limits = parse_space(body)
                elif kind == MSG_LAYOUT:
                    head.layout = parse_layout(body)
                elif kind == MSG_FILTERS:
                    head.filters = parse_filters(body)
                elif kind == MSG_FILL:
                    head.fill = parse_fill(body)
                elif kind == MSG_EXTERNAL:
                    raise UnsupportedType(f"{self.file.path}: data in external files")
        return head

    # Groups

    def children(self, group: tuple):
        """``(name, header address)`` of a group's members, in name order."""
        tree, heap = group
        for nodes in self.pages(tree, 1):
            yield from self.members(heap, nodes)

    def pages(self, tree: int, size: int):
        """Addresses of a group's symbol nodes, ``size`` at a time; members are not read."""
        leaves = self._group_leaves(tree)
        while page := list(islice(leaves, size)):
            yield page

    def members(self, heap: int, nodes: list[int]):
        """``(name, header address)`` of the members in some symbol nodes of a group.

        All entries are read first, then their names in few runs, so the file is not read
        to and fro for every member.
        """
        entries = []
        for node in nodes:
            signature, _, _, count = struct.unpack("<4sBBH", self.read(node, 8))
            if signature != b"SNOD":
                raise CorruptFile(f"{self.file.path}: no symbol node at {node}")
            table = self.read(node + 8, count * 40)
            entries += [struct.unpack_from("<QQ", table, i * 40) for i in range(count)]
        names = self._names_at(heap, [at for at, _ in entries])
        for at, address in entries:
            yield names[at], address

    def _names_at(self, heap: int, places: list[int]) -> dict[int, str]:
        """Names from a group's heap; only their own bytes, and small gaps, are asked for."""
        if heap not in self._names:
            signature, size, _, data = struct.unpack("<4s4xQQQ", self.read(heap, 32))
            if signature != b"HEAP":
                raise CorruptFile(f"{self.file.path}: no local heap at {heap}")
            self._names = {heap: (data, size)}
        data, size = self._names[heap]
        found, run = {}, []

        def read_run():
            text, low = b"", run[0]
            for at in run:
                while (end := text.find(b"\0", at - low)) < 0:
                    if low + len(text) >= size:
                        raise CorruptFile(f"{self.file.path}: a name at {at} has no end")
                    more = max(run[-1] + NAME_BYTES - low - len(text), len(text), NAME_BYTES)
                    text += self.read(data + low + len(text), min(more, size - low - len(text)))
                found[at] = text[at - low : end].decode("utf-8")

        for at in sorted(set(places)):
            if run and at - run[-1] > NAME_GAP:
                read_run()
                run = []
            run.append(at)
        if run:
            read_run()
        return found

    def _member(self, group: tuple, name: str) -> int | None:
        """Header address of one member, by the names that part the nodes of the tree."""
        tree, heap = group
        level, count = self._tree_head(tree, 0)
        while True:
            body = self.read(tree + 24, count * 16 + 8)
            keys, children = (struct.unpack_from(f"<{count}Q", b"".join(body[i * 16 + k : i * 16 + k + 8] for i in range(count))) for k in (16, 8))
            low, high = 0, count - 1  # the key behind a child is its largest name
            while low < high:
                middle = (low + high) // 2
                if name.encode() <= self._names_at(heap, [keys[middle]])[keys[middle]].encode():
                    high = middle
                else:
                    low = middle + 1
            if not count:
                return None
            if not level:
                return next((a for n, a in self.members(heap, [children[low]]) if n == name), None)
            tree = children[low]
            level, count = self._tree_head(tree, 0)

    def _group_leaves(self, address: int):
        level, count = self._tree_head(address, 0)
        body = self.read(address + 24, count * 16 + 8)
        for i in range(count):
            child = struct.unpack_from("<Q", body, i * 16 + 8)[0]
            if level:
                yield from self._group_leaves(child)
            else:
                yield child

    def _tree_head(self, address: int, kind: int) -> tuple[int, int]:
        signature, found, level, count = struct.unpack("<4sBBH", self.read(address, 8))
        if signature != b"TREE" or found != kind:
            raise CorruptFile(f"{self.file.path}: no B-tree of kind {kind} at {address}")
        return level, count

    def walk(self, address: int | None = None, path: str = "", above: tuple = (), depth: int | None = None):
        """``(path, header or error, address, above)`` of a group and all below it.

        Depth first with an explicit stack of generators, which holds one
        branch and never the whole tree.  Groups ``depth`` levels down are
        listed but not entered; nor is a link back to a group of the branch,
        whose B-tree addresses ``above`` holds.
        """
        address = self.root if address is None else address
        top = self.header(address)
        yield path or "/", top, address, above
        stack = [(path, (*above, top.group[0]), self.children(top.group))] if top.group else []
        while stack:
            prefix, branch, siblings = stack[-1]
            child = next(siblings, None)
            if child is None:
                stack.pop()
                continue
            here = f"{prefix}/{child[0]}"
            try:
                head = self.header(child[1])
            except UnsupportedType as error:
                yield here, error, child[1], branch
                continue
            yield here, head, child[1], branch
            entered = depth is None or len(stack) < depth
            if entered and head.group and head.group[0] not in branch:
                stack.append((here, (*branch, head.group[0]), self.children(head.group)))

    def find(self, path: str) -> Header:
        head = self.header(self.root)
        for part in [p for p in path.split("/") if p]:
            address = None
            if head.group:
                address = self._member(head.group, part)
            if address is None:
                raise ArrayError(f"{self.file.path}: no object {path}")
            head = self.header(address)
        return head

    # Chunks and variable-length data

    def chunk_entries(self, address: int, rank: int, first: tuple, last: tuple):
        """``(origin, address, bytes, filter mask)`` of chunks from ``first`` to ``last``.

        Keys are ordered by chunk origin, so subtrees outside are not visited.
        """
        if address == UNDEFINED:
            return
        level, count = self._tree_head(address, 1)
        key_size = 8 + 8 * (rank + 1)
        body = self.read(address + 24, count * (key_size + 8) + key_size)

        def key(i):
            at = i * (key_size + 8)
            size, mask, *offsets = struct.unpack_from(f"<II{rank + 1}Q", body, at)
            return size, mask, tuple(offsets[:rank])

        for i in range(count):
            size, mask, origin = key(i)
            child = struct.unpack_from("<Q", body, i * (key_size + 8) + key_size)[0]
            if origin > last:
                return
            if level:
                if i + 1 < count and key(i + 1)[2] <= first:
                    continue
                yield from self.chunk_entries(child, rank, first, last)
            elif origin >= first:
                yield origin, child, size, mask

    def heap_object(self, address: int, index: int) -> bytes:
        if address not in self._heaps:
            signature, size = struct.unpack("<4s4xQ", self.read(address, 16))
            if signature != b"GCOL":
                raise CorruptFile(f"{self.file.path}: no global heap at {address}")
            data, at, objects = self.read(address, size), 16, {}
            while at + 16 <= size:
                number, _, length = struct.unpack_from("<HH4xQ", data, at)
                if number == 0:
                    break
                objects[number] = data[at + 16 : at + 16 + length]
                at += 16 + -(-length // 8) * 8
            if len(self._heaps) >= 16:
                self._heaps.pop(next(iter(self._heaps)))
            self._heaps[address] = objects
        return self._heaps[address][index]


UNDEFINED = 2**64 - 1


def _name(data: bytes, at: int, padded: bool) -> tuple[str, int]:
    end = data.index(b"\0", at)
    length = end - at + 1
    return data[at:end].decode("utf-8"), at + (-(-length // 8) * 8 if padded else length)


def parse_type(data: bytes, at: int) -> tuple[ElementType, int]:
    """A datatype message and the offset behind it."""
    packed, b0, b1, _, size = struct.unpack_from("<BBBBI", data, at)
    version, code, at = packed >> 4, packed & 15, at + 8
    bits = b0 | b1 << 8
    kind = ElementType(code, size, order=">" if bits & 1 else "<")
    name = kind.class_name
    if name == "INTEGER":
        offset, precision = struct.unpack_from("<HH", data, at)
        if (offset, precision) != (0, 8 * size):
            raise UnsupportedType(f"integer of {precision} bits from bit {offset} of {size} bytes")
        kind.signed = bool(bits & 8)
        return kind, at + 4
    if name == "FLOAT":
        return kind, at + 12
    if name == "STRING":
        kind.padding = STRING_PADDING.get(bits & 15, "nullpad")
        return kind, at
    if name == "BITFIELD":
        return kind, at + 4
    if name == "TIME":
        return kind, at + 2
    if name == "OPAQUE":
        return kind, at + (b0 + 7) // 8 * 8
    if name == "REFERENCE":
        return kind, at
    if name == "COMPOUND":
        for _ in range(bits):
            member, at = _name(data, at, version < 3)
            if version == 3:
                width = max(1, (size.bit_length() + 7) // 8)
                offset, at = int.from_bytes(data[at : at + width], "little"), at + width
                dims = ()
            else:
                offset, at = struct.unpack_from("<I", data, at)[0], at + 4
                dims = ()
                if version == 1:
                    rank = data[at]
                    dims = struct.unpack_from("<4I", data, at + 12)[:rank]
                    at += 28
            part, at = parse_type(data, at)
            if dims:
                part = ElementType(10, prod(dims) * part.size, base=part, shape=tuple(dims))
            kind.members.append((member, offset, part))
        return kind, at
    if name == "ENUM":
        kind.base, at = parse_type(data, at)
        names = []
        for _ in range(bits):
            label, at = _name(data, at, version < 3)
            names.append(label)
        codes = np.frombuffer(data, kind.base.numpy(), bits, at)
        kind.labels = [(n, int(c)) for n, c in zip(names, codes)]
        kind.signed, kind.order = kind.base.signed, kind.base.order
        return kind, at + bits * kind.base.size
    if name == "VLEN":
        kind.variable_string = (bits & 15) == 1
        kind.base, at = parse_type(data, at)
        return kind, at
    if name == "ARRAY":
        rank, at = data[at], at + (4 if version < 3 else 1)
        kind.shape = struct.unpack_from(f"<{rank}I", data, at)
        at += 4 * rank * (2 if version < 3 else 1)
        kind.base, at = parse_type(data, at)
        return kind, at
    raise UnsupportedType(f"element class {code}")


def parse_space(data: bytes) -> tuple[tuple, tuple]:
    version, rank, flags = data[0], data[1], data[2]
    if version not in (1, 2):
        raise UnsupportedType(f"dataspace version {version}")
    if version == 2 and data[3] == 2:
        raise UnsupportedType("null dataspace")
    at = 8 if version == 1 else 4
    shape = struct.unpack_from(f"<{rank}Q", data, at)
    limits = struct.unpack_from(f"<{rank}Q", data, at + 8 * rank) if flags & 1 else shape
    return shape, limits


def parse_layout(data: bytes) -> tuple:
    version, kind = data[0], data[1]
    if version != 3:
        raise UnsupportedType(f"data layout version {version}")
    if kind == 0:
        size = struct.unpack_from("<H", data, 2)[0]
        return "compact", data[4 : 4 + size]
    if kind == 1:
        return "contiguous", struct.unpack_from("<Q", data, 2)[0]
    if kind == 2:
        rank = data[2] - 1
        address = struct.unpack_from("<Q", data, 3)[0]
        return "chunked", address, struct.unpack_from(f"<{rank}I", data, 11)
    raise UnsupportedType(f"data layout class {kind}")


def parse_filters(data: bytes) -> list[int]:
    version, count = data[0], data[1]
    at, ids = (8 if version == 1 else 2), []
    for _ in range(count):
        number, length = struct.unpack_from("<HH", data, at)
        if version == 1 or number >= 256:
            _, values = struct.unpack_from("<HH", data, at + 4)
            at += 8 + (-(-length // 8) * 8 if version == 1 else length)
        else:
            _, values = struct.unpack_from("<HH", data, at + 2)
            at += 6
        at += 4 * values
        if version == 1 and values % 2:
            at += 4
        ids.append(number)
    return ids


def parse_fill(data: bytes) -> bytes | None:
    version = data[0]
    if version == 2 and data[3]:
        size = struct.unpack_from("<I", data, 4)[0]
        return data[8 : 8 + size] if size else None
    if version == 3 and data[1] & 0x20:
        size = struct.unpack_from("<I", data, 2)[0]
        return data[6 : 6 + size]
    return None


class Hdf5Dataset:
    """One dataset as an array: dataset dimensions first, element dimensions last."""

    suffixes = (".h5", ".hdf5", ".hdf", ".he5")

    def __init__(self, file: RangedFile, options: dict):
        path = options.get("dataset")
        if not path:
            raise ArrayError("option 'dataset' is required")
        self.h5 = Hdf5File(file)
        self.head = self.h5.find(path)
        if self.head.kind != "dataset":
            raise ArrayError(f"{file.path}: {path} is a {self.head.kind}, not a dataset")
        self.schema = describe(path, self.head)
        self.element = self.head.element
        self.raw = self.element.numpy()
        self.outer = len(self.head.shape) or 1
        if self.element.class_name == "COMPOUND":
            self.parts = [(n, t) for n, _, t in self.element.members]
        else:
            self.parts = [(self.schema.attrs[0].name, _inner(self.element))]
        self.columns = [(n, t.spark()) for n, t in self.parts]
        # numpy turns an array element into trailing axes; keep one record per cell.
        self.record = self.raw.base if self.raw.subdtype else self.raw
        # What is read at once: file chunks, else the chunk plan, finer where
        # records are wide or drag variable-length data along.
        inside = [d.size for d in self.schema.dims if d.inside]
        if self.head.layout and self.head.layout[0] == "chunked":
            steps = [*self.head.layout[2], *inside]
        else:
            cells = min(CHUNK_CELLS, max(1, READ_BYTES // self.record.itemsize))
            if self.element.has_variable_length:
                cells = min(cells, VARIABLE_CELLS)
            steps = chunk_plan(self.schema.shape, cells, len(inside))
        self.file_dims = self.schema.with_chunks(steps).dims

    def prepare(self, first, last) -> None:
        """Look up the file chunks of a run of slabs in one walk of the index."""
        if self.head.layout and self.head.layout[0] == "chunked":
            _, address, chunk = self.head.layout
            first, last = tuple(first[: self.outer]), tuple(last[: self.outer])
            entries = self.h5.chunk_entries(address, len(chunk), first, last)
            self.found = {origin: rest for origin, *rest in entries}

    def read_box(self, lo, extent) -> np.ndarray:
        layout, shape = self.head.layout, [d.size for d in self.file_dims]
        if layout and layout[0] == "compact":
            whole = np.frombuffer(layout[1], self.record, prod(shape)).reshape(shape)
            return whole[_box(lo, extent)].reshape(-1)
        if layout and layout[0] == "chunked":
            return self._chunk_box(lo, extent)
        if not layout or layout[1] == UNDEFINED:
            return self._filled(lo, extent)
        start = self.h5.base + layout[1]
        return read_contiguous(self.h5.file, start, self.record, shape, lo, extent)

    def _filled(self, lo, extent) -> np.ndarray:
        """Cells that were never written: the fill value, or zero."""
        fill = self.head.fill
        if not fill or len(fill) != self.raw.itemsize:
            return np.zeros(prod(extent), self.record)
        inside = [d.size for d in self.file_dims if d.inside]
        cell = np.frombuffer(fill, self.record).reshape(inside)
        outer = len(lo) - len(inside)
        cell = cell[_box(lo[outer:], extent[outer:])]
        return np.broadcast_to(cell, extent).reshape(-1)

    def _chunk_box(self, lo, extent) -> np.ndarray:
        """A box within one file chunk."""
        chunk = self.head.layout[2]
        origin = tuple(c * (a // c) for a, c in zip(lo[: self.outer], chunk))
        if origin not in self.found:
            return self._filled(lo, extent)
        at, size, mask = self.found[origin]
        data = self.h5.read(at, size)
        for place in reversed(range(len(self.head.filters))):
            if not mask >> place & 1:
                data = _undo(self.head.filters[place], data, self.raw.itemsize)
        full = [*chunk, *[d.size for d in self.file_dims if d.inside]]
        if len(data) < prod(full) * self.record.itemsize:
            raise CorruptFile(f"{self.h5.file.path}: chunk at {at} is cut short")
        whole = np.frombuffer(data, self.record, prod(full)).reshape(full)
        within = [a - o for a, o in zip(lo, [*origin, *[0] * (len(lo) - len(origin))])]
        return whole[_box(within, extent)].reshape(-1)

    def to_arrow(self, raw: np.ndarray, names: list[str]) -> list[pa.Array]:
        kinds = dict(self.parts)
        if self.element.class_name == "COMPOUND":
            return [decode(raw[n], kinds[n], self.h5) for n in names]
        return [decode(raw, kinds[n], self.h5) for n in names]


def _box(lo, extent):
    return tuple(slice(a, a + n) for a, n in zip(lo, extent))


def _inner(kind: ElementType) -> ElementType:
    return kind.base if kind.class_name == "ARRAY" else kind


def _undo(number: int, data: bytes, width: int) -> bytes:
    if number == FILTER_DEFLATE:
        return zlib.decompress(data)
    if number == FILTER_SHUFFLE:
        rows = len(data) // width
        body = np.frombuffer(data, "u1", rows * width).reshape(width, rows).T
        return body.tobytes() + data[rows * width :]
    raise UnsupportedType(f"filter {number}")


def describe(path: str, head: Header) -> ArraySchema:
    """Array description of a dataset: names, types, bounds and the chunk plan."""
    element = head.element
    kind = element.class_name
    if kind == "COMPOUND":
        attrs = tuple(Attr(n, t.type_name) for n, _, t in element.members)
    else:
        inner = _inner(element)
        prefix = {"INTEGER": "int", "FLOAT": "float", "STRING": "str"}.get(inner.class_name)
        if prefix is None or kind not in ("INTEGER", "FLOAT", "ARRAY"):
            raise UnsupportedType(f"{path}: element class {kind}")
        attrs = (Attr(f"{prefix}1", inner.type_name),)
    dims = []
    for i, (size, limit) in enumerate(zip(head.shape or (1,), head.limits or (1,))):
        dims.append(Dim(f"unnamed{i}", size, limit=min(limit, UNLIMITED)))
    for size in element.shape if kind == "ARRAY" else ():
        dims.append(Dim(f"unnamed{len(dims)}", size, inside=True))
    return ArraySchema(path.rsplit("/", 1)[-1], attrs, tuple(dims)).planned()


def decode(raw: np.ndarray, kind: ElementType, h5: Hdf5File | None) -> pa.Array:
    """Elements as Arrow values in native byte order."""
    name = kind.class_name
    if name in ("INTEGER", "ENUM"):
        if kind.signed:
            return pa.array(raw.astype(f"i{kind.size}"))
        if kind.size == 8:
            return pa.array(raw.astype("u8")).cast(pa.decimal128(20, 0))
        return pa.array(raw.astype(f"i{2 * kind.size}"))
    if name == "FLOAT":
        return pa.array(raw.astype("f4" if kind.size < 8 else "f8"))
    if name == "STRING":
        flat = np.ascontiguousarray(raw).view(f"S{kind.size}").reshape(-1)
        return _trim(pa.array(flat, pa.binary()), kind.padding)
    if name == "COMPOUND":
        arrays = [decode(raw[n], t, h5) for n, _, t in kind.members]
        return pa.StructArray.from_arrays(arrays, names=[n for n, _, _ in kind.members])
    if name == "ARRAY":
        rows, width = len(raw), prod(kind.shape)
        offsets = pa.array(np.arange(rows + 1, dtype="i4") * width)
        flat = np.ascontiguousarray(raw).reshape(rows * width)
        return pa.ListArray.from_arrays(offsets, decode(flat, kind.base, h5))
    if name == "VLEN":
        blobs = [
            h5.heap_object(int(a), int(i))[: int(c) * kind.base.size] if c else b""
            for c, a, i in zip(raw["count"], raw["heap"], raw["index"])
        ]
        if kind.variable_string:
            return _trim(pa.array(blobs, pa.binary()), "nullterm")
        offsets = np.concatenate([[0], np.cumsum(raw["count"])]).astype("i4")
        flat = np.frombuffer(b"".join(blobs), kind.base.numpy())
        return pa.ListArray.from_arrays(pa.array(offsets), decode(flat, kind.base, h5))
    raise UnsupportedType(f"element class {name}")


def _trim(values: pa.Array, padding: str) -> pa.Array:
    """Fixed text without its padding (numpy has dropped trailing zero bytes)."""
    if padding == "nullterm":
        values = pc.list_element(pc.split_pattern(values, b"\0", max_splits=1), 0)
    try:
        text = pc.cast(values, pa.string())
    except pa.ArrowInvalid:  # not UTF-8: odd bytes become replacement characters
        text = pa.array([v if v is None else v.decode("utf-8", "replace") for v in values.to_pylist()], pa.string())
    return pc.utf8_rtrim(text, " ") if padding == "spacepad" else text
