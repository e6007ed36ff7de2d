"""Column functions: types, names, coordinates, bytes, text and time."""

from slabwise.functions.binary import decode_int, fixed_string, physical_value
from slabwise.functions.coords import (
    delinearize,
    integer_div,
    linearize,
    slab_cell_count,
    slab_number,
    slab_origin,
)
from slabwise.functions.text import c_number, sanitize_name
from slabwise.functions.time import (
    from_timestamp,
    from_wall_clock,
    to_timestamp,
    to_wall_clock,
)
from slabwise.functions.types import (
    class_supported,
    enum_label,
    fits_type_name,
    float_type_name,
    int_type_name,
    spark_type_name,
    type_bytes,
)

__all__ = [
    "c_number",
    "class_supported",
    "decode_int",
    "delinearize",
    "enum_label",
    "fits_type_name",
    "fixed_string",
    "float_type_name",
    "from_timestamp",
    "from_wall_clock",
    "int_type_name",
    "integer_div",
    "linearize",
    "physical_value",
    "sanitize_name",
    "slab_cell_count",
    "slab_number",
    "slab_origin",
    "spark_type_name",
    "to_timestamp",
    "to_wall_clock",
    "type_bytes",
]
