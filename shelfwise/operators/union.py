"""Union of frames whose columns differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there."""
    if not frames:
        raise ValueError("no frame to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
