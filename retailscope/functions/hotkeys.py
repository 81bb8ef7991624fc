"""Joins that one key cannot slow down, without relying on adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_GROUPS = 1000


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: str | Sequence[str], size: str, total: int | Column, hint: str | None = None,
) -> DataFrame:
    """Give every row the columns of its group, whatever share of the rows one group holds.

    ``groups`` has one row per key with the number of its rows in ``size``; the numbers add up to
    ``total`` (per part of the table, where it is a column). Groups with more than ``total / HOT_GROUPS``
    rows are fewer than ``HOT_GROUPS`` (per part) by arithmetic, so they are broadcast and their rows never
    move; the rest meet in a join that Spark chooses by size, or as ``hint`` says. ``groups`` is read three
    times: pass a written table.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    hot = F.col(size) * HOT_GROUPS > (F.lit(total) if isinstance(total, int) else total)
    few = F.broadcast(groups.where(hot))
    stay = rows.join(few, keys)
    move = rows.join(F.broadcast(groups.where(hot).select(*keys)), keys, "left_anti")
    rest = groups.where(~hot)
    return stay.unionByName(move.join(rest.hint(hint) if hint else rest, keys))
