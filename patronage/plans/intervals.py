"""Figures as of several observation days from one state for each key and interval.

Days cut time into intervals. Every row goes to the interval it falls in, rows of
one (key, interval) are added up once, and a running merge over a key's intervals
gives the state at each observation day. A key has at most one state an interval,
so what is moved does not grow with rows x days; the states are handed to the
observation days after the last exchange, where they are the result's own rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronage.functions.columns import ntz


@dataclass(frozen=True)
class Timeline:
    """Observation ``days``, and the end of the ``horizon`` that follows each (0: none).

    Interval i ends before cut i, so an observation day at cut p sees intervals 0..p.
    """

    days: tuple[date, ...]
    horizon: int = 0

    def window_end(self, day: date) -> date:
        return day + timedelta(days=self.horizon)

    @property
    def cuts(self) -> list[date]:
        return sorted({*self.days, *(self.window_end(d) for d in self.days)})

    def interval(self, ts) -> Column:
        """The interval that ``ts`` falls in; null for a null."""
        return reduce(add, [(F.col(ts) >= ntz(str(c))).cast("int") for c in self.cuts])

    def _seen_at(self, interval: Column) -> Column:
        """Cut of the first observation day that sees the interval; null if none does."""
        cuts = self.cuts
        at = sorted(cuts.index(d) for d in self.days)
        first = [next((p for p in at if p >= i), None) for i in range(len(cuts) + 1)]
        return F.element_at(F.array(*[F.lit(p).cast("int") for p in first]), interval + 1)

    def known_from(self, interval: Column, event) -> Column:
        """The interval from which a row of ``interval`` counts when it counts only
        once ``event`` (a time) has passed: its own where no observation day lies
        between, else the cut of the first day after the event; null if none."""
        row, then = self._seen_at(interval), self._seen_at(self.interval(event))
        return F.when(then <= row, interval).when(then > row, then)

    def observed(self, states: DataFrame, start: str, end: str, day: str, cut: str, until: str) -> DataFrame:
        """A row for each observation day that lies in a state's cuts ``start``..``end`` - 1,
        with the ``day``, its ``cut`` and the cut that ends its horizon (``until``)."""
        cuts = self.cuts
        every = F.array(*[F.struct(F.lit(cuts.index(d)).alias("p"), F.lit(cuts.index(self.window_end(d))).alias("q"),
                                   ntz(str(d)).alias("d")) for d in sorted(set(self.days))])
        hit = F.explode(F.filter(every, lambda o: (o["p"] >= F.col(start)) & (o["p"] < F.col(end))))
        return states.withColumn("__hit", hit) \
            .withColumns({day: F.col("__hit.d"), cut: F.col("__hit.p"), until: F.col("__hit.q")}).drop("__hit")


def running(states: DataFrame, key: str, at: str, merges: dict[str, Callable[[str], Column]], timeline: Timeline,
            nxt: str, whole: dict[str, Column] | None = None) -> DataFrame:
    """Each state merged with the key's states before it (``merges``: column → aggregate),
    ``nxt`` = the interval of the key's next state, and ``whole``: aggregates over all
    states of the key. One sort; a key has one row an interval."""
    w = Window.partitionBy(key).orderBy(at)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = [merge(c).over(upto).alias(c) for c, merge in merges.items()]
    cols += [c.over(every).alias(name) for name, c in (whole or {}).items()]
    return states.select(key, at, F.lead(at, 1, len(timeline.cuts) + 1).over(w).alias(nxt), *cols)
