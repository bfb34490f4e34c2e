from .writers import (
    metric_rows,
    remove,
    rewrite_partitions,
    shared_folder,
    staged,
    write_csv,
    write_json,
    write_partitioned,
)

__all__ = [
    "metric_rows",
    "remove",
    "rewrite_partitions",
    "shared_folder",
    "staged",
    "write_csv",
    "write_json",
    "write_partitioned",
]
