"""The pipeline over a data directory, and the analyses over its tables.

A thin front for callers who want ``load``, ``parse``, ``group`` and the five analyses by name.  All of
it stays lazy except the strict check, the size profile, the shared counts of the analyses and an
optional write of the parsed lines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from logweft import functions as fn
from logweft import operators as ops
from logweft import sources
from logweft.plans import blocks, findings, lines


class LogPipeline:
    """Log, template and label files to parsed lines and block records."""

    def __init__(
        self,
        spark: SparkSession,
        data_dir: str,
        log: str = "HDFS.log",
        templates: str = "HDFS.log_templates.csv",
        labels: str = "anomaly_label.csv",
        truth: str | None = None,
    ):
        self.spark = spark
        self._log, self._templates, self._labels = (
            f"{data_dir.rstrip('/')}/{name}" for name in (log, templates, labels)
        )
        self._truth = truth and f"{data_dir.rstrip('/')}/{truth}"
        self.logs: DataFrame | None = None
        self.labels: DataFrame | None = None
        self.expected: DataFrame | None = None
        self.parsed: DataFrame | None = None
        self.blocks: DataFrame | None = None

    def load(self) -> "LogPipeline":
        self.logs = sources.read_log(self.spark, self._log)
        self.labels = fn.encode_labels(sources.read_labels(self.spark, self._labels))
        if self._truth:
            self.expected = sources.truth_event_counts(sources.read_truth(self.spark, self._truth))
        return self

    def parse(self, strict: bool = True, save_to: str | None = None) -> "LogPipeline":
        """Fields, event and time of each line; with truth sequences and ``strict``, checked.

        ``save_to`` writes the parsed lines as Parquet and continues from there, so that later
        analyses read only the columns they use instead of scanning the text again.  The job that
        writes them also counts what the check needs.
        """
        markers = fn.collect_markers(sources.read_templates(self.spark, self._templates))
        parsed = fn.parse_timestamp(fn.parse_fields(fn.classify(self.logs, markers)))
        strict, counts = strict and self.expected is not None, None
        if save_to:
            rows, counts = ops.watched(parsed, self.expected) if strict else (parsed, None)
            rows.write.parquet(save_to)
            parsed = self.spark.read.schema(parsed.schema).parquet(save_to)
        if counts:
            counts.check()
        elif strict:
            ops.check_parsed(parsed, self.expected)
        self.parsed = parsed
        self._saved = bool(save_to)
        for derived in ("in_blocks", "in_order", "profile"):
            self.__dict__.pop(derived, None)
        return self

    def group(
        self,
        layout: Callable[[DataFrame], DataFrame] | None = None,
        default_normal: bool = False,
    ) -> "LogPipeline":
        """Block records of the lines that name a block, under an optional partition layout.

        ``default_normal`` labels a block without a known label 0 instead of NULL.
        """
        rows = layout(self.in_order) if layout else self.in_order
        build = ops.block_records_default0 if default_normal else ops.block_records
        self.blocks = build(rows, self.labels, self.profile)
        return self

    @cached_property
    def in_blocks(self) -> DataFrame:
        """The parsed lines that name a block."""
        return fn.drop_missing_blocks(self.parsed)

    @cached_property
    def in_order(self) -> DataFrame:
        """``in_blocks`` for what sorts lines; saved lines have one line number in place of file and split."""
        return sources.number_lines(self.in_blocks) if self._saved else self.in_blocks

    @cached_property
    def profile(self) -> ops.BlockProfile:
        """The oversized blocks, found once for everything that orders lines."""
        return ops.profile_blocks(self.in_blocks)

    def pipeline(self) -> "LogPipeline":
        return self.load().parse().group()


class LogAnalyzer:
    """The five analyses over a parsed pipeline."""

    def __init__(self, pipeline: LogPipeline):
        self.pipeline = pipeline
        self.parsed = pipeline.parsed
        self.in_blocks = pipeline.in_blocks
        self.labels = pipeline.labels
        self.results: dict[str, DataFrame | dict[str, DataFrame]] = {}

    @cached_property
    def activity(self) -> DataFrame:
        """Lines by component, level and hour, counted once and written: three analyses read these."""
        return sources.settle(lines.activity_counts(self.parsed), "activity")

    def analyze_error_frequencies(self) -> DataFrame:
        self.results["error_frequencies"] = lines.error_frequencies(self.activity)
        return self.results["error_frequencies"]

    def analyze_peak_activity_times(self) -> DataFrame:
        self.results["peak_activity_times"] = lines.hourly_activity(self.activity)
        return self.results["peak_activity_times"]

    def analyze_failure_patterns(self) -> DataFrame:
        sequences = blocks.anomaly_sequences(self.pipeline.in_order, self.labels, self.pipeline.profile)
        self.results["failure_patterns"] = {
            "anomaly_events": sequences,
            "component_comparison": blocks.component_by_label(self.in_blocks, self.labels),
            "label_summary": blocks.label_summary(self.in_blocks, self.labels),
        }
        return sequences

    def analyze_log_level_distribution(self) -> DataFrame:
        self.results["log_level_distribution"] = lines.level_distribution(self.activity)
        return self.results["log_level_distribution"]

    def analyze_performance_metrics(self) -> DataFrame:
        latencies = blocks.component_latency(self.in_blocks, self.labels)
        self.results["performance_metrics"] = {
            "latency_stats": blocks.latency_stats(self.in_blocks, self.labels),
            "component_latency": latencies,
        }
        return latencies

    def run_all_analyses(self) -> dict[str, DataFrame | dict[str, DataFrame]]:
        self.analyze_error_frequencies()
        self.analyze_peak_activity_times()
        self.analyze_failure_patterns()
        self.analyze_log_level_distribution()
        self.analyze_performance_metrics()
        return self.results

    @cached_property
    def grouped(self) -> DataFrame:
        """Counts by level, hour, component and block from one scan, written."""
        return sources.settle(lines.grouped_counts(self.parsed, blocks=True), "grouped")

    def key_findings(self) -> DataFrame:
        return findings.of_grouped(self.grouped, self.labels)
