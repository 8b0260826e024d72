from logweft.functions.arrays import array_to_string, register_functions
from logweft.functions.events import (
    classify,
    classify_by_index,
    collect_markers,
    event_by_chain,
    event_by_index,
    with_markers,
)
from logweft.functions.fields import (
    FIELD_PATTERNS,
    drop_missing_blocks,
    field,
    parse_fields,
    parse_time,
    parse_timestamp,
)
from logweft.functions.labels import encode_label, encode_labels

__all__ = [
    "FIELD_PATTERNS",
    "array_to_string",
    "classify",
    "classify_by_index",
    "collect_markers",
    "drop_missing_blocks",
    "encode_label",
    "encode_labels",
    "event_by_chain",
    "event_by_index",
    "field",
    "parse_fields",
    "parse_time",
    "parse_timestamp",
    "register_functions",
    "with_markers",
]
