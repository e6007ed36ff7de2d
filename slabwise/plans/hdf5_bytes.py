"""HDF5 files built byte by byte from the public format specification.

Only for deriving test files from tables: superblock 0, symbol-table groups,
version 1 object headers, contiguous or chunked (one index node per level) data.
"""

from __future__ import annotations

import struct
import zlib
from math import prod

import numpy as np

UNDEFINED = 2**64 - 1
LEAF_K, INTERNAL_K, CHUNK_K = 4, 16, 32  # fixed values: the format's default node sizes


# Datatype messages


def int_type(size: int, signed: bool = True, big: bool = False) -> bytes:
    return struct.pack("<BBBBIHH", 0x10, big | signed << 3, 0, 0, size, 0, 8 * size)


def float_type(size: int, big: bool = False) -> bytes:
    exponent, mantissa, bias = {4: (8, 23, 127), 8: (11, 52, 1023), 2: (5, 10, 15)}[size]
    sign = 8 * size - 1
    return struct.pack(
        "<BBBBIHHBBBBI", 0x11, 0x20 | big, sign, 0, size, 0, 8 * size, mantissa, exponent, 0, mantissa, bias
    )


def string_type(size: int, padding: int = 1) -> bytes:
    return struct.pack("<BBBBI", 0x13, padding, 0, 0, size)


def opaque_type(size: int) -> bytes:
    return struct.pack("<BBBBI", 0x15, 0, 0, 0, size)


def compound_type(size: int, members: list[tuple[str, int, bytes]], version: int = 2) -> bytes:
    out = struct.pack("<BHBI", version << 4 | 6, len(members), 0, size)
    for name, offset, message in members:
        out += _padded(name) + struct.pack("<I", offset)
        if version == 1:
            out += bytes(28)
        out += message
    return out


def enum_type(base: bytes, labels: dict[str, int]) -> bytes:
    size = struct.unpack_from("<I", base, 4)[0]
    out = struct.pack("<BHBI", 0x18, len(labels), 0, size) + base
    out += b"".join(_padded(name) for name in labels)
    return out + b"".join(code.to_bytes(size, "little") for code in labels.values())


def vlen_type(base: bytes, text: bool = False) -> bytes:
    return struct.pack("<BBBBI", 0x19, int(text), 0, 0, 16) + base


def array_type(shape, base: bytes) -> bytes:
    size = prod(shape) * struct.unpack_from("<I", base, 4)[0]
    out = struct.pack("<BBBBIB3x", 0x2A, 0, 0, 0, size, len(shape))
    return out + struct.pack(f"<{len(shape)}I", *shape) + bytes(4 * len(shape)) + base


def _padded(name: str) -> bytes:
    raw = name.encode() + b"\0"
    return raw.ljust(-(-len(raw) // 8) * 8, b"\0")


# Files


class FileBuilder:
    """Collects datasets under paths, then gives the bytes of the file."""

    def __init__(self):
        self.out = bytearray(96)
        self.tree: dict = {}

    def _put(self, data: bytes) -> int:
        self.out += bytes(-len(self.out) % 8)
        address = len(self.out)
        self.out += data
        return address

    def heap(self, blobs: list[bytes]) -> list[tuple[int, int, int]]:
        """Blobs in one global heap: ``(bytes, address, index)`` each."""
        body = b""
        for i, blob in enumerate(blobs):
            body += struct.pack("<HH4xQ", i + 1, 1, len(blob)) + blob + bytes(-len(blob) % 8)
        body += struct.pack("<HH4xQ", 0, 0, 0)
        size = max(4096, 16 + len(body))
        at = self._put((b"GCOL" + struct.pack("<B3xQ", 1, size) + body).ljust(size, b"\0"))
        return [(len(blob), at, i + 1) for i, blob in enumerate(blobs)]

    def dataset(
        self, path: str, kind: bytes, shape, data: bytes | np.ndarray, limits=None,
        chunk=None, shuffle=False, deflate=False, fill: bytes | None = None, skip=(),
    ) -> None:
        """``limits`` holds ``None`` for an unlimited dimension; ``skip`` chunks are left out."""
        raw = data.tobytes() if isinstance(data, np.ndarray) else data
        width = struct.unpack_from("<I", kind, 4)[0]
        messages = [(1, _space(shape, limits)), (3, kind)]
        if fill is not None:
            messages.append((5, struct.pack("<BBBBI", 2, 2, 0, 1, len(fill)) + fill))
        if chunk is None:
            at = self._put(raw) if raw else UNDEFINED
            messages.append((8, struct.pack("<BBQQ", 3, 1, at, len(raw))))
        else:
            filters = ([(2, [width])] if shuffle else []) + ([(1, [6])] if deflate else [])
            if filters:
                body = struct.pack("<BB6x", 1, len(filters))
                for number, values in filters:
                    body += struct.pack("<HHHHI4x", number, 0, 1, len(values), *values)
                messages.append((11, body))
            at = self._chunks(raw, width, shape, chunk, shuffle, deflate, skip)
            dims = [*chunk, width]
            messages.append((8, struct.pack(f"<BBBQ{len(dims)}I", 3, 2, len(dims), at, *dims)))
        *groups, name = [p for p in path.split("/") if p]
        node = self.tree
        for group in groups:
            node = node.setdefault(group, {})
        node[name] = self._header(messages)

    def _header(self, messages: list[tuple[int, bytes]]) -> int:
        body = b""
        for number, data in messages:
            data += bytes(-len(data) % 8)
            body += struct.pack("<HHB3x", number, len(data), 0) + data
        return self._put(struct.pack("<BBHII4x", 1, 0, len(messages), 1, len(body)) + body)

    def _chunks(self, raw, width, shape, chunk, shuffle, deflate, skip) -> int:
        whole = np.frombuffer(raw, f"V{width}").reshape(shape)
        counts = [-(-n // c) for n, c in zip(shape, chunk)]
        entries = []
        for index in np.ndindex(*counts):
            if index in skip:
                continue
            origin = [i * c for i, c in zip(index, chunk)]
            piece = np.zeros(chunk, f"V{width}")
            part = whole[tuple(slice(o, o + c) for o, c in zip(origin, chunk))]
            piece[tuple(slice(0, n) for n in part.shape)] = part
            data = piece.tobytes()
            if shuffle:
                data = np.frombuffer(data, "u1").reshape(-1, width).T.tobytes()
            if deflate:
                data = zlib.compress(data)
            entries.append((len(data), origin, self._put(data)))
        if not entries:
            return UNDEFINED
        last = [c * n for c, n in zip(chunk, counts)]
        level = 0
        while level == 0 or len(entries) > 1:
            groups = [entries[i : i + 2 * CHUNK_K] for i in range(0, len(entries), 2 * CHUNK_K)]
            nodes = []
            for place, group in enumerate(groups):
                body = b"TREE" + struct.pack("<BBHQQ", 1, level, len(group), UNDEFINED, UNDEFINED)
                for size, origin, address in group:
                    body += _key(size, origin) + struct.pack("<Q", address)
                after = groups[place + 1][0][1] if place + 1 < len(groups) else last
                body += _key(0, after)
                full = 24 + 2 * CHUNK_K * 8 + (2 * CHUNK_K + 1) * len(_key(0, last))
                nodes.append((group[0][0], group[0][1], self._put(body.ljust(full, b"\0"))))
            entries, level = nodes, level + 1
        return entries[0][2]

    def _group(self, node: dict) -> tuple[int, int, int]:
        """``(header, B-tree, heap)`` addresses of a group and all below it."""
        names = sorted(node)
        addresses = [self._group(node[n])[0] if isinstance(node[n], dict) else node[n] for n in names]
        text, places = bytearray(8), []
        for name in names:
            places.append(len(text))
            text += _padded(name)
        data = self._put(bytes(text))
        heap = self._put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(text), 1, data))
        leaves = []
        for first in range(0, max(len(names), 1), 2 * LEAF_K):
            part = list(zip(places, addresses))[first : first + 2 * LEAF_K]
            body = b"SNOD" + struct.pack("<BBH", 1, 0, len(part))
            body += b"".join(struct.pack("<QQII16x", p, a, 0, 0) for p, a in part)
            leaves.append((part[-1][0] if part else 0, self._put(body.ljust(8 + 2 * LEAF_K * 40, b"\0"))))
        level = 0
        while True:
            nodes = []
            for first in range(0, len(leaves), 2 * INTERNAL_K):
                part = leaves[first : first + 2 * INTERNAL_K]
                before = leaves[first - 1][0] if first else 0
                body = b"TREE" + struct.pack("<BBHQQQ", 0, level, len(part), UNDEFINED, UNDEFINED, before)
                body += b"".join(struct.pack("<QQ", child, key) for key, child in part)
                nodes.append((part[-1][0], self._put(body.ljust(24 + 2 * INTERNAL_K * 16 + 8, b"\0"))))
            if len(nodes) == 1:
                break
            leaves, level = nodes, level + 1
        tree = nodes[0][1]
        return self._header([(17, struct.pack("<QQ", tree, heap))]), tree, heap

    def build(self, user_block: int = 0) -> bytes:
        header, tree, heap = self._group(self.tree)
        start = b"\x89HDF\r\n\x1a\n" + struct.pack(
            "<BBBBBBBBHHI", 0, 0, 0, 0, 0, 8, 8, 0, LEAF_K, INTERNAL_K, 0
        )
        start += struct.pack("<QQQQ", user_block, UNDEFINED, len(self.out), UNDEFINED)
        start += struct.pack("<QQIIQQ", 0, header, 1, 0, tree, heap)
        self.out[:96] = start
        return bytes(user_block) + bytes(self.out)


def _space(shape, limits) -> bytes:
    out = struct.pack("<BBB5x", 1, len(shape), int(limits is not None))
    out += struct.pack(f"<{len(shape)}Q", *shape)
    if limits is not None:
        out += struct.pack(f"<{len(shape)}Q", *[UNDEFINED if n is None else n for n in limits])
    return out


def _key(size: int, origin) -> bytes:
    return struct.pack(f"<II{len(origin) + 1}Q", size, 0, *origin, 0)
