"""Sums that are kept between runs, so that a refresh reads only what is new."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..sources.appended import AppendedTable
from ..sources.versions import VersionedTable

Build = Callable[[DataFrame], DataFrame]
Add = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class CourseSums:
    """Exact partial sums of a streamed table, one row per course.

    Version n of the stored sums covers all batches up to version n of ``source``, so what is
    missing is known without a note of its own, and a refresh that stops half-way has
    stored nothing. ``build`` sums rows, ``add`` adds two tables of sums.
    """

    source: AppendedTable
    build: Build
    add: Add

    @property
    def stored(self) -> VersionedTable:
        return VersionedTable(self.source.spark, f"{self.source.name}_sums")

    def missing(self, known: int | None = None) -> DataFrame:
        """Rows of the batches that are not in the stored sums, which go up to version ``known``."""
        known = self.stored.latest() if known is None else known
        return self.source.read(after=-1 if known is None else known)

    def refresh(self) -> DataFrame:
        """The sums over all batches, after adding those that are new."""
        latest, known = self.source.latest(), self.stored.latest()
        if latest is None:
            # Nothing has been stored yet: sums of no rows.
            return self.build(self.source.spark.table(self.source.name))
        if known is not None and known > latest:
            raise ValueError(
                f"{self.stored.table} covers version {known} but {self.source.name} ends at {latest}:"
                " the table was made anew; drop its sums as well"
            )
        if known != latest:
            new = self.build(self.missing(known))
            if known is not None:
                new = self.add(self.stored.read(), new)
            self.stored.write(new, version=latest)
            if known is not None:
                # The version before stays for who is reading it.
                self.stored.expire(keep_last=2)
        return self.stored.read()
