"""Trip-record analytics as Spark jobs: landing, quality, typing, summaries, run records."""

from meterline.config import Layout, QualityBounds, build_session

__all__ = ["Layout", "QualityBounds", "build_session"]
