"""The common form of every strategy: which rows go, which rows come in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOTHING = None
EVERYTHING = "TRUE"


@dataclass(frozen=True)
class Change:
    """Next state = target rows for which ``goes`` is not true, plus ``rows``.

    ``goes`` is a SQL predicate over the target's columns built from typed
    literals only, so a published table can hold on to its stored files and
    put the predicate in front of them instead of rewriting the rows that stay.
    """

    goes: str | None
    rows: DataFrame

    @property
    def keep(self) -> str:
        """The predicate of the rows that stay; unknown counts as not going."""
        if self.goes is NOTHING:
            return "TRUE"
        return "FALSE" if self.goes == EVERYTHING else keep_unless(self.goes)

    def apply(self, target: DataFrame | None) -> DataFrame:
        if self.goes == EVERYTHING or target is None:
            return self.rows
        kept = target if self.goes is NOTHING else target.filter(F.expr(self.keep))
        return kept.union(self.rows)


def keep_unless(predicate: str) -> str:
    return f"NOT coalesce({predicate}, FALSE)"
