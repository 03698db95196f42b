"""Organisation-profile analytics as Spark DataFrame jobs."""

from orgloom.schemas import DATASETS, Dataset, ExtractionSpec

__all__ = ["DATASETS", "Dataset", "ExtractionSpec"]
