"""What source file names say: snapshots with a coverage cutoff, and daily files.

Fixed values: apcYYYYMMDD-YYYYMMDD-NN.zip is part NN of a snapshot, apcYYMMDD.zip a daily.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAPSHOT = r"(?i)^apc(\d{8})-(\d{8})-(\d+)\.zip$"
DAILY = r"(?i)^apc(\d{6})\.zip$"


class Source(NamedTuple):
    """kind: snapshot or daily; day: the cutoff or the transaction day."""

    name: str
    kind: str
    day: date
    part: int


def _day(text: str) -> date | None:
    try:
        return date(int(text[:4]), int(text[4:6]), int(text[6:]))
    except ValueError:
        return None


def parsed(name: str) -> Source | None:
    """None for a name that is neither."""
    if m := re.match(SNAPSHOT, name):
        start, cutoff = _day(m[1]), _day(m[2])
        return Source(name, "snapshot", cutoff, int(m[3])) if start and cutoff else None
    if m := re.match(DAILY, name):
        day = _day(("20" if int(m[1][:2]) < 50 else "19") + m[1])
        return Source(name, "daily", day, 0) if day else None
    return None


def selected(names: Iterable[str]) -> tuple[date | None, list[Source]]:
    """(cutoff, inputs): all parts of the newest snapshot, and the dailies after its cutoff, in order."""
    found = sorted({s for s in map(parsed, names) if s}, key=lambda s: (s.day, s.kind == "daily", s.part, s.name))
    cutoffs = [s.day for s in found if s.kind == "snapshot"]
    cutoff = max(cutoffs, default=None)
    return cutoff, [s for s in found if (s.kind == "snapshot" and s.day == cutoff) or (s.kind == "daily" and (cutoff is None or s.day > cutoff))]


def prunable(names: Iterable[str]) -> list[str]:
    """Dailies that the newest snapshot covers."""
    names = list(names)
    cutoff, _ = selected(names)
    return [s.name for s in map(parsed, names) if s and s.kind == "daily" and cutoff and s.day <= cutoff]


def missing(offered: Iterable[str], held: Iterable[str]) -> list[str]:
    """What to fetch of the names offered: the inputs of a build over them that are not held yet."""
    held = set(held)
    return [s.name for s in selected(offered)[1] if s.name not in held]


def file_day(name: Column) -> Column:
    """The day of a source file name as an expression; null for other names."""
    cutoff = F.regexp_extract(name, SNAPSHOT, 2)
    short = F.regexp_extract(name, DAILY, 1)
    full = F.when(cutoff != "", cutoff).when(short != "", F.concat(F.when(F.substring(short, 1, 2) < "50", "20").otherwise("19"), short))
    return F.try_to_timestamp(full, F.lit("yyyyMMdd")).cast("date")
