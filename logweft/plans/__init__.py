from logweft.plans import blocks, findings, lines
from logweft.plans.pipeline import LogAnalyzer, LogPipeline

__all__ = ["LogAnalyzer", "LogPipeline", "blocks", "findings", "lines"]
