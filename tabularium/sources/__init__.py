"""Scans, sinks and file inventory."""

from tabularium.sources.delimited import (
    REJECTED,
    read_delimited,
    read_headed_csv,
    read_lookup,
    reject_counts,
    write_headed_csv,
)
from tabularium.sources.inventory import file_inventory, list_files, parquet_inventory
from tabularium.sources import schemas
from tabularium.sources.partitioned import read_keys, read_partition, save_table, write_partitioned
from tabularium.sources.snapshot import is_snapshot, publish, read_snapshot, remove_versions, versions
