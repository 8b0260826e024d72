"""Label text to number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode_label(label: Column | str = "Label") -> Column:
    """Normal is 0, Anomaly is 1, any other text is NULL."""
    text = F.col(label) if isinstance(label, str) else label
    return F.when(text == "Normal", F.lit(0)).when(text == "Anomaly", F.lit(1))


def encode_labels(labels: DataFrame) -> DataFrame:
    """``Label`` as a number; ``LabelText`` keeps what was written, known or not."""
    return labels.withColumns({"LabelText": F.col("Label"), "Label": encode_label()})
