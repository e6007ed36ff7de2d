"""File formats and stored arrays."""

from slabwise.sources.catalog import fits_catalog, fits_header, hdf5_catalog, list_files
from slabwise.sources.export import dump_dataset, dump_files, write_dump
from slabwise.sources.scan import (
    describe_fits,
    describe_hdf5,
    load_fits,
    load_hdf5,
    register,
    scan_listed,
)
from slabwise.sources.store import (
    array_versions,
    open_array,
    store_array,
    store_fits,
    store_hdf5,
    vacuum_array,
)

__all__ = [
    "array_versions",
    "describe_fits",
    "describe_hdf5",
    "dump_dataset",
    "dump_files",
    "fits_catalog",
    "fits_header",
    "hdf5_catalog",
    "list_files",
    "load_fits",
    "load_hdf5",
    "open_array",
    "register",
    "scan_listed",
    "store_array",
    "store_fits",
    "store_hdf5",
    "vacuum_array",
    "write_dump",
]
