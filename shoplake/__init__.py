"""E-commerce lakehouse jobs on Spark: CSV and event ingest, order facts, daily metrics."""

from shoplake.config import LakeConfig

__all__ = ["LakeConfig"]
