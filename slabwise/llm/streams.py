"""Passes over rows that Spark has sorted by a key, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before (the first always does)."""
    out = np.ones(len(columns[0]), bool)
    if len(out) > 1:
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


#: States of a row.  OPEN: its key decides.  SETTLED: it stays, and nobody needs to know.
#: WITNESS: it stays, and its key has several documents already.
OPEN, SETTLED, WITNESS = 0, 1, 2
#: Rows that a task looks at together before they are exchanged.
COMBINED_ROWS = 1 << 20


def combine(keys: list[str], doc: str, later: bool):
    """Settle what a task can tell alone, so that a hot key is a few rows per task afterwards.

    Adds ``state``.  ``later`` False is for ``in_several``: of a key with several documents
    in the task, one row goes on as witness.  True is for ``after_first``: rows behind the
    task's first document of a key are settled.
    """

    def settle(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        columns = [rows[k].to_numpy() for k in keys]
        docs = rows[doc].to_numpy()
        order = np.lexsort((docs, *columns[::-1]))
        starts = np.flatnonzero(_changes(*(c[order] for c in columns)))
        ends = np.append(starts[1:], len(order))
        docs, sizes = docs[order], ends - starts
        if later:
            state = np.where(docs != np.repeat(docs[starts], sizes), SETTLED, OPEN)
        else:
            state = np.where(np.repeat(docs[starts] != docs[ends - 1], sizes), SETTLED, OPEN)
            state[starts] *= WITNESS
        out = np.empty(len(order), np.int8)
        out[order] = state
        batch = rows.to_batches()[0]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "state"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= COMBINED_ROWS:
                yield settle(held)
                held, n = [], 0
        if n:
            yield settle(held)

    return run


def in_several(keys: list[str], doc: str):
    """Rows whose key stands in two documents at least; input from ``combine``, sorted by the
    key, the state (descending) and the document.

    Of an unfinished key only the rows of its first document are held back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key, first, several = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            docs, state = (batch.column(c).to_numpy(zero_copy_only=False) for c in (doc, "state"))
            starts = np.flatnonzero(_changes(*columns))
            ends = np.append(starts[1:], len(docs))
            many = (np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)) | (np.maximum.reduceat(state, starts) == WITNESS)
            if key == tuple(c[0] for c in columns):  # the first run goes on from the batch before
                many[0] |= several or docs[0] != first
                opening = first
                if many[0]:
                    yield from held
                    held = []
            else:
                opening, held = docs[0], []
            keep = np.repeat(many, ends - starts) | (state != OPEN)
            last = len(starts) - 1
            key, several = tuple(c[starts[last]] for c in columns), bool(many[last])
            first = opening if last == 0 else docs[starts[last]]
            if keep.any():
                yield batch.filter(pa.array(keep))
            if several:
                held = []
            else:
                rest = batch.slice(starts[last])
                rest = rest.filter(pa.array(state[starts[last] :] == OPEN))  # settled rows are out already
                held = [*held, rest] if last == 0 else [rest]

    return run


def after_first(keys: list[str], doc: str):
    """Rows whose key stands in an earlier document too; input from ``combine``, sorted by the
    key and the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            settled = batch.column("state").to_numpy(zero_copy_only=False) != OPEN
            if settled.any():
                yield batch.filter(pa.array(settled))
                batch = batch.filter(pa.array(~settled))
                if not batch.num_rows:
                    continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            docs = batch.column(doc).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(_changes(*columns))
            firsts = docs[starts].copy()
            if key == tuple(c[0] for c in columns):
                firsts[0] = first
            key, first = tuple(c[starts[-1]] for c in columns), firsts[-1]
            later = docs != np.repeat(firsts, np.diff(np.append(starts, len(docs))))
            if later.any():
                yield batch.filter(pa.array(later))

    return run
