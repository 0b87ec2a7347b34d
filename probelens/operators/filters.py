"""Dashboard filter state compiled to one Spark predicate (FLT-1 ... FLT-9).

A :class:`FilterSpec` holds the six optional selections of the dashboard.
``spec.predicate(view)`` compiles the parts that view applies into a single
``Column``; parts that are unset, or whose column the input lacks, are
skipped, as in the source application. Because the predicate only touches
``aggregation_date``, ``hour``, ``Operatorname`` and the route key, it is
pushed below the aggregation into the scan, and on a curated table the date
parts prune partitions.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens import config as C
from probelens.functions.derive import iso_weekday

# Which predicate each view applies (fixed).
VIEW_PARTS = {
    "overview": frozenset({"date", "weekday", "hour", "operator"}),
    "route": frozenset({"date", "weekday", "route", "hour", "operator"}),
    "stop": frozenset({"date", "weekday", "hour", "operator"}),
    "ab": frozenset({"date", "weekday", "route", "operator"}),
}

_PART_COLUMNS = {
    "date": "aggregation_date",
    "weekday": "aggregation_date",
    "route": "Journey_Pattern_ID",
    "hour": "hour",
    "operator": "Operatorname",
}


@dataclass(frozen=True)
class FilterSpec:
    """Selections of the dashboard's common filter bar.

    * ``date_range``: inclusive ``(start, end)`` dates (FLT-1)
    * ``weekdays``: ISO numbers, Monday=1 ... Sunday=7 (FLT-2, FLT-8)
    * ``routes``: route keys; empty means all routes (FLT-3)
    * ``hour_bands``: inclusive ``(start, end)`` hour bands, OR-ed (FLT-4, FLT-7)
    * ``operator``: one operator; None means all (FLT-5)
    """

    date_range: tuple[dt.date, dt.date] | None = None
    weekdays: tuple[int, ...] | None = None
    routes: tuple[str, ...] = ()
    hour_bands: tuple[tuple[int, int], ...] | None = None
    operator: str | None = None

    def parts(self, columns: Iterable[str], view: str) -> list[Column]:
        """The predicates ``view`` applies, given the input's columns."""
        cols = set(columns)
        wanted = VIEW_PARTS[view]
        out: list[Column] = []

        def usable(part: str) -> bool:
            return part in wanted and _PART_COLUMNS[part] in cols

        if self.date_range and usable("date"):
            start, end = self.date_range
            out.append(F.col("aggregation_date").between(F.lit(start), F.lit(end)))
        if self.weekdays and usable("weekday"):
            out.append(iso_weekday("aggregation_date").isin(*sorted(set(self.weekdays))))
        if self.routes and usable("route"):
            out.append(F.col("Journey_Pattern_ID").isin(*sorted(set(self.routes))))
        if self.hour_bands and usable("hour"):
            out.append(hour_in_bands(F.col("hour"), self.hour_bands))
        if self.operator is not None and usable("operator"):
            out.append(F.col("Operatorname") == F.lit(self.operator))
        return out

    def predicate(self, columns: Iterable[str], view: str) -> Column | None:
        parts = self.parts(columns, view)
        if not parts:
            return None
        pred = parts[0]
        for p in parts[1:]:
            pred = pred & p
        return pred

    def apply(self, df: DataFrame, view: str) -> DataFrame:
        """Filter ``df`` with the parts ``view`` applies."""
        pred = self.predicate(df.columns, view)
        return df if pred is None else df.where(pred)

    # -- normalisation of raw dashboard selections ------------------------

    @classmethod
    def from_selection(
        cls,
        date_input=None,
        weekday_names: Sequence[str] | None = None,
        routes: Sequence[str] | None = None,
        hour_band_labels: Sequence[str] | None = None,
        operator_choice: str | None = None,
    ) -> FilterSpec:
        """Build a spec from widget values as the dashboard offers them."""
        return cls(
            date_range=normalize_date_input(date_input),
            weekdays=weekday_numbers(weekday_names),
            routes=tuple(routes or ()),
            hour_bands=hour_bands_from_labels(hour_band_labels),
            operator=operator_from_choice(operator_choice),
        )


def hour_in_bands(hour: Column, bands: Sequence[tuple[int, int]]) -> Column:
    """FLT-4/FLT-7: hour inside any of the inclusive bands (null hour: no)."""
    pred = None
    for start, end in bands:
        p = hour.between(int(start), int(end))
        pred = p if pred is None else (pred | p)
    return pred if pred is not None else F.lit(True)


def parse_band(label: str) -> tuple[int, int]:
    """FLT-6: ``"07-09"`` to ``(7, 9)``; both ends inclusive. Any other text is refused."""
    found = re.fullmatch(r"(\d{1,2})-(\d{1,2})", label.strip())
    if not found or not int(found[1]) <= int(found[2]) <= 24:
        raise ValueError(f"not an hour band: {label!r} (expected e.g. 06-10)")
    return int(found[1]), int(found[2])


def hour_bands_from_labels(labels: Sequence[str] | None) -> tuple[tuple[int, int], ...] | None:
    """FLT-7: the chosen bands; "all" or nothing chosen means no hour predicate.

    The union of the chosen bands is kept as is (D5), not their hull.
    """
    if not labels or C.ALL_CHOICE in labels:
        return None
    return tuple(parse_band(x) for x in labels)


def weekday_numbers(names: Sequence[str] | None) -> tuple[int, ...] | None:
    """FLT-8: weekday names to ISO numbers; "all" or nothing means no filter."""
    if not names or C.ALL_CHOICE in names:
        return None
    if unknown := [n for n in names if n not in C.WEEKDAY_NUMBERS]:
        raise ValueError(f"unknown weekday: {', '.join(unknown)} (known: {', '.join(C.WEEKDAY_NUMBERS)})")
    return tuple(C.WEEKDAY_NUMBERS[n] for n in names)


def normalize_date_input(value) -> tuple[dt.date, dt.date]:
    """FLT-9: a pair stays a pair, a single day becomes ``(d, d)``,
    anything else falls back to the default range."""
    if isinstance(value, (tuple, list)) and len(value) == 2:
        return _as_date(value[0]), _as_date(value[1])
    if isinstance(value, (dt.date, str)):
        d = _as_date(value)
        return d, d
    return C.DEFAULT_DATE_RANGE


def operator_from_choice(choice: str | None) -> str | None:
    """FLT-5: the "all" choice means no operator predicate."""
    if choice is None or choice == C.ALL_CHOICE:
        return None
    return choice


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v))
