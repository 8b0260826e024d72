from logweft.sources.files import (
    LINE_ORDER,
    line_order,
    number_lines,
    read_labels,
    read_log,
    read_templates,
    read_truth,
    truth_event_counts,
)
from logweft.sources.scratch import new_folder, settle

__all__ = [
    "LINE_ORDER",
    "line_order",
    "new_folder",
    "number_lines",
    "read_labels",
    "read_log",
    "read_templates",
    "read_truth",
    "settle",
    "truth_event_counts",
]
