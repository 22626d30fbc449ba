"""stray: ranking users who stray from the herd, as Spark DataFrame jobs."""

from stray.config import PipelineConfig

__all__ = ["PipelineConfig"]
