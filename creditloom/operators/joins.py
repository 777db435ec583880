"""Joins whose detail side may hold most of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def left_join_detail(owners: DataFrame, detail: DataFrame, on: Sequence[str]) -> DataFrame:
    """All owners with their detail rows; owners without detail keep one row of missing values.

    A plain left join cannot split a hot key on its right side. Here the matches come from
    an inner join, where AQE may split either side, and the owners without a match are
    added from the distinct keys alone.
    """
    on = list(on)
    matched = owners.join(detail, on)
    alone = owners.join(detail.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
