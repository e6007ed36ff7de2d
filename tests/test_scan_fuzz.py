"""Random shapes, chunks, bounds and splits against numpy, without Spark."""

import numpy as np
import pyarrow as pa
from hypothesis import HealthCheck, given, settings, strategies as st

from slabwise.plans import fits_bytes, hdf5_bytes as h5
from slabwise.sources.scan import read_split

RULES = settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def bounds(data, shape):
    low = [data.draw(st.one_of(st.none(), st.integers(0, n - 1))) for n in shape]
    high = [data.draw(st.one_of(st.none(), st.integers(a or 0, n - 1))) for a, n in zip(low, shape)]
    text = {k: ",".join("*" if v is None else str(v) for v in side) for k, side in (("lo", low), ("hi", high))}
    box = tuple(slice(a or 0, n if b is None else b + 1) for a, b, n in zip(low, high, shape))
    return text, box


def collect(form, path, options, parts):
    batches = [b for part in range(parts) for b in read_split(form, path, part, parts, options)]
    return pa.Table.from_batches(batches).to_pylist() if batches else []


def check(form, path, options, parts, array, box, dims, attr):
    """``array`` is indexed in schema order."""
    expected = {}
    for index in np.ndindex(*array[box].shape):
        at = tuple(i + s.start for i, s in zip(index, box))
        expected[at] = array[at]
    rows = collect(form, path, options, parts)
    got = {tuple(r[d] for d in dims): r[attr] for r in rows}
    assert len(rows) == len(got) and got == expected
    # Slabs hold the same cells, each exactly once.
    total = 0
    for slab in collect(form, path, {**options, "layout": "slabs"}, parts):
        at = tuple(slice(slab[f"origin_{d}"], slab[f"last_{d}"] + 1) for d in dims)
        values = array[at]
        flat = values.transpose().reshape(-1) if form == "fits_image" else values.reshape(-1)
        assert slab[attr] == flat.tolist()
        total += len(slab[attr])
    assert total == len(expected)


@RULES
@given(data=st.data())
def test_hdf5(tmp_path, data):
    outer = data.draw(st.lists(st.integers(1, 7), min_size=1, max_size=3))
    inner = data.draw(st.lists(st.integers(1, 4), max_size=2))
    shape = (*outer, *inner)
    array = np.arange(np.prod(shape), dtype="<i4").reshape(shape)
    chunk = data.draw(st.one_of(st.none(), st.tuples(*[st.integers(1, n + 1) for n in outer])))
    kind = h5.array_type(inner, h5.int_type(4)) if inner else h5.int_type(4)
    file = h5.FileBuilder()
    file.dataset("/d", kind, outer, array, chunk=chunk, shuffle=data.draw(st.booleans()) if chunk else False,
                 deflate=data.draw(st.booleans()) if chunk else False)
    path = tmp_path / "f.h5"
    path.write_bytes(file.build())
    options, box = bounds(data, shape)
    dims = [f"unnamed{i}" for i in range(len(shape))]
    parts = data.draw(st.integers(1, 5))
    check("hdf5_array", str(path), {**options, "dataset": "/d"}, parts, array, box, dims, "int1")


@RULES
@given(data=st.data())
def test_fits(tmp_path, data):
    shape = data.draw(st.lists(st.integers(1, 6), min_size=1, max_size=4))
    stored = np.arange(np.prod(shape), dtype="i4").reshape(shape)
    path = tmp_path / "f.fits"
    path.write_bytes(fits_bytes.primary() + fits_bytes.image(stored, 32))
    array = stored.transpose()  # dim0 is the last axis of the stored array
    options, box = bounds(data, array.shape)
    dims = [f"dim{i}" for i in range(len(shape))]
    parts = data.draw(st.integers(1, 5))
    check("fits_image", str(path), {**options, "hdu": "1"}, parts, array, box, dims, "unknown")


@RULES
@given(data=st.data())
def test_small_reading_units(tmp_path, data):
    """Splitting within dimensions, as plans of very large arrays do."""
    from unittest import mock

    shape = data.draw(st.lists(st.integers(1, 7), min_size=1, max_size=3))
    array = np.arange(np.prod(shape), dtype="<i4").reshape(shape)
    file = h5.FileBuilder()
    file.dataset("/d", h5.int_type(4), shape, array)
    path = tmp_path / "f.h5"
    path.write_bytes(file.build())
    options, box = bounds(data, shape)
    dims = [f"unnamed{i}" for i in range(len(shape))]
    with mock.patch("slabwise.sources.hdf5.READ_BYTES", data.draw(st.sampled_from([4, 12, 40, 100]))):
        check("hdf5_array", str(path), {**options, "dataset": "/d"}, data.draw(st.integers(1, 4)), array, box, dims, "int1")
