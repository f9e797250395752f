"""Client segmentation and scoring as Spark jobs."""

from stratiscore.config import Settings

__all__ = ["Settings"]
