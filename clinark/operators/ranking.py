"""Ordered slices: top-k reports and offset pages of reports, always lazy.

A top-k in Spark keeps the first rows of every partition and merges them in one task, so
``limit`` and ``offset`` are meant for reports. Pages of a large table find the folder
that holds the offset first (``serving.patients_page``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def ordered_slice(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """Rows ranked [offset, offset+limit) by ``order``, which must be a total order
    (rows equal on it are identical), returned in that order."""
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be >= 0")
    top = df.orderBy(*order)
    return (top.offset(offset) if offset else top).limit(limit)
