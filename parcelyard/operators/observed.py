"""Count rows that meet conditions while their table is written."""

from __future__ import annotations

from collections.abc import Hashable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class CountedRows:
    """Rows per watched table, and how many of them meet each of its conditions.

    The counts are metrics of the job that writes a table, so they cost no scan of their
    own. Put :meth:`watch` last, directly before the write: the metrics then belong to the
    tasks that write, each of which counts once even if it is run again, while tasks
    before a shuffle would count anew after a lost executor.
    """

    def __init__(self) -> None:
        self._watched: dict[str, tuple[Observation, list[Hashable]]] = {}

    def watch(self, table: str, df: DataFrame, conditions: Mapping[Hashable, Column]) -> DataFrame:
        """``df``, whose first write counts its rows and those that meet each condition.

        A condition that is null for a row does not count. Watching a table again
        replaces its earlier counts.
        """
        observation = Observation()
        self._watched[table] = (observation, list(conditions))
        counts = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())]
        return df.observe(observation, F.count(F.lit(1)).alias("n_rows"), *counts)

    def __contains__(self, table: str) -> bool:
        return table in self._watched

    def rows(self, table: str) -> int:
        """Rows that the table had when it was written."""
        return self._watched[table][0].get["n_rows"]

    def matching(self, table: str) -> dict[Hashable, int]:
        """Rows of the table that met each condition."""
        observation, names = self._watched[table]
        found = observation.get
        return {name: found[f"c{i}"] for i, name in enumerate(names)}
