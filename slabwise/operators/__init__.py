"""Array operators: DataFrame in, DataFrame out."""

from slabwise.operators.align import align_asof, align_frames
from slabwise.operators.chunks import (
    array_size,
    buffer_bytes,
    dense_check,
    dense_check_box,
    dim_bounds,
    holes,
    slab_bytes,
    slab_grid,
)
from slabwise.operators.curve import curve_number, redistribute_by_curve, slab_curve
from slabwise.operators.dump import array_ddl, dump_frames, dump_records, show_schema, write_lines
from slabwise.operators.pack import pack_frames, pack_slabs
from slabwise.operators.query import (
    avg_all,
    count_cells,
    first_n_elements,
    first_n_slabs,
    stats_by_dim,
    stdev_by_dim,
    subarray,
    subarray_slabs,
    touching_slabs,
)
from slabwise.operators.ragged import pack_ragged, prefix_sums, unpack_lists, unpack_ragged
from slabwise.operators.restructure import (
    array_member_to_cols,
    compound_to_attrs,
    flatten_compound,
    name_attrs,
    name_dims,
    redistribute,
    scalar_array,
    split_attrs,
    unpack_slabs,
    unroll,
    unroll_nested,
    vlen_unwrap,
)
from slabwise.operators.synopsis import box_stats, with_synopses

__all__ = [
    "align_asof",
    "align_frames",
    "array_ddl",
    "array_member_to_cols",
    "array_size",
    "avg_all",
    "box_stats",
    "buffer_bytes",
    "compound_to_attrs",
    "count_cells",
    "curve_number",
    "dense_check",
    "dense_check_box",
    "dim_bounds",
    "dump_frames",
    "dump_records",
    "first_n_elements",
    "first_n_slabs",
    "flatten_compound",
    "holes",
    "name_attrs",
    "name_dims",
    "pack_frames",
    "pack_ragged",
    "pack_slabs",
    "prefix_sums",
    "redistribute",
    "redistribute_by_curve",
    "scalar_array",
    "show_schema",
    "slab_bytes",
    "slab_curve",
    "slab_grid",
    "split_attrs",
    "stats_by_dim",
    "stdev_by_dim",
    "subarray",
    "subarray_slabs",
    "touching_slabs",
    "unpack_lists",
    "unpack_ragged",
    "unpack_slabs",
    "unroll",
    "unroll_nested",
    "vlen_unwrap",
    "with_synopses",
    "write_lines",
]
