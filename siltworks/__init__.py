"""Data-quality, feature-preparation and run-KPI operators for Spark DataFrames."""

from siltworks.config import CostModel, PrepConfig, Thresholds

__all__ = ["CostModel", "PrepConfig", "Thresholds"]
