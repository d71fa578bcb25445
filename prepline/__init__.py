"""Spark jobs for preparing, selecting, scoring and monitoring tabular data
for binary classification."""

from prepline.catalog import Catalog, Variable

__all__ = ["Catalog", "Variable"]
