"""Reading tables, day partitions and whole files."""

from dayfold.sources.files import whole_files
from dayfold.sources.scans import (
    day_range_scan,
    day_scan,
    load_or_none,
    multi_scan,
    query_view,
    scan,
    use_database,
)

__all__ = [
    "day_range_scan",
    "day_scan",
    "load_or_none",
    "multi_scan",
    "query_view",
    "scan",
    "use_database",
    "whole_files",
]
