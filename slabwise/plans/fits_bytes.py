"""FITS image units built from arrays, for deriving test files from tables."""

from __future__ import annotations

import numpy as np

BLOCK = 2880


def card(key: str, value, comment: str = "") -> bytes:
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, str):
        text = f"'{value:<8}'".ljust(20)
    else:
        text = f"{value!r:>20}"
    line = f"{key:<8}= {text}" + (f" / {comment}" if comment else "")
    return line.ljust(80).encode("ascii")


def header(cards: list[tuple]) -> bytes:
    body = b"".join(card(*c) for c in cards) + b"END".ljust(80)
    return body.ljust(-(-len(body) // BLOCK) * BLOCK)


def primary() -> bytes:
    """An empty primary unit."""
    return header(
        [
            ("SIMPLE", True, "conforms to FITS standard"),
            ("BITPIX", 8, "array data type"),
            ("NAXIS", 0, "number of array dimensions"),
            ("EXTEND", True),
        ]
    )


def image(data: np.ndarray, bitpix: int, extra: list[tuple] = (), first: bool = False) -> bytes:
    """An image unit; the last axis of ``data`` becomes NAXIS1."""
    cards = [("SIMPLE", True)] if first else [("XTENSION", "IMAGE", "Image extension")]
    cards += [("BITPIX", bitpix), ("NAXIS", data.ndim)]
    cards += [(f"NAXIS{i + 1}", n) for i, n in enumerate(reversed(data.shape))]
    if not first:
        cards += [("PCOUNT", 0), ("GCOUNT", 1)]
    types = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
    body = data.astype(types[bitpix]).tobytes()
    return header([*cards, *extra]) + body.ljust(-(-len(body) // BLOCK) * BLOCK, b"\0")
