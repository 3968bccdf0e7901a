"""Writing results: tables, day partitions, keyed documents, text."""

from dayfold.sinks.bulk import read_bulk, write_bulk
from dayfold.sinks.documents import (
    METRICS_RESOURCE,
    append_docs,
    compact_docs,
    current_docs,
    drop_batches,
    latest_per_id,
    metrics_upsert,
    upsert_docs,
)
from dayfold.sinks.shared import shared_path, write_aside
from dayfold.sinks.tables import (
    append_table,
    drop_old_days,
    read_text,
    swap_day,
    write_day,
    write_day_table,
    write_text,
)

__all__ = [
    "METRICS_RESOURCE",
    "append_docs",
    "append_table",
    "compact_docs",
    "current_docs",
    "drop_batches",
    "drop_old_days",
    "latest_per_id",
    "metrics_upsert",
    "read_bulk",
    "read_text",
    "shared_path",
    "swap_day",
    "upsert_docs",
    "write_aside",
    "write_bulk",
    "write_day",
    "write_day_table",
    "write_text",
]
