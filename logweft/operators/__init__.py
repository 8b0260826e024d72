from logweft.operators.blocks import (
    block_latency,
    block_records,
    block_records_default0,
    block_spans,
    event_intervals,
    order_columns,
    sequence_events,
)
from logweft.operators.labels import first_labels, label_counts
from logweft.operators.layout import LAYOUTS, SHUFFLE_WIDTHS, bucketed, latency_at_width, store
from logweft.operators.skew import BlockProfile, StoredLines, parts_of, profile_blocks
from logweft.operators.validate import (
    check_parsed,
    event_count_check,
    event_count_violations,
    event_counts,
    missing_blocks,
    watched,
)

__all__ = [
    "LAYOUTS",
    "SHUFFLE_WIDTHS",
    "BlockProfile",
    "StoredLines",
    "block_latency",
    "block_records",
    "block_records_default0",
    "block_spans",
    "bucketed",
    "check_parsed",
    "event_count_check",
    "event_count_violations",
    "event_counts",
    "event_intervals",
    "first_labels",
    "label_counts",
    "latency_at_width",
    "missing_blocks",
    "order_columns",
    "parts_of",
    "profile_blocks",
    "sequence_events",
    "store",
    "watched",
]
