"""A set of star-schema tables by name, loaded on first use."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


class Star(Mapping):
    """Read-only mapping from table name to DataFrame.

    The queries of this package take a ``Star``; it may be backed by the published
    warehouse, by the tables derived from the test data, or by frames given directly.
    """

    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._frames:
            loader = self._loaders[table]
            self._frames[table] = loader() if callable(loader) else loader
        return self._frames[table]

    def __iter__(self):
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)

    def replace(self, **frames: DataFrame) -> Star:
        """The same star with some tables swapped, e.g. filtered by a page context."""
        return Star({**self._loaders, **self._frames, **frames})

    def register_views(self) -> None:
        """Make every table available to SQL under its own name."""
        for table in self:
            self[table].createOrReplaceTempView(table)
