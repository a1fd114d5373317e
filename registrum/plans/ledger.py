"""What jobs have done: a journal of entries, from which the state of every unit of work follows.

The journal is only appended to.  A unit's state is its last entry: open, held (by a worker, until
a time), done or failed; whoever holds a unit too long loses it to the next who asks.  Executors
never touch it, since task retries are Spark's.
"""

from __future__ import annotations

import sqlite3
import time
from collections.abc import Callable, Iterable
from contextlib import contextmanager

_SET_UP = (
    "CREATE TABLE IF NOT EXISTS entry (number INTEGER PRIMARY KEY, written REAL, stage TEXT, unit TEXT, state TEXT, until REAL, note TEXT)",
    "CREATE INDEX IF NOT EXISTS entry_unit ON entry (stage, unit, number)",
    "CREATE TABLE IF NOT EXISTS fact (kind TEXT, name TEXT, value TEXT, PRIMARY KEY (kind, name))",
    "CREATE VIEW IF NOT EXISTS standing AS SELECT stage, unit, state, until, note FROM entry WHERE number IN (SELECT max(number) FROM entry GROUP BY stage, unit)",
)
HOLD_SECONDS, NOTE_LENGTH = 900.0, 2000


class Journal:
    """One file, any number of processes on one machine."""

    def __init__(self, path: str, clock: Callable[[], float] = time.time):
        self.clock = clock
        self.file = sqlite3.connect(path, isolation_level=None, timeout=60)
        for statement in _SET_UP:
            self.file.execute(statement)

    @contextmanager
    def _alone(self):
        """Nobody else writes in between."""
        self.file.execute("BEGIN IMMEDIATE")
        try:
            yield
        except BaseException:
            self.file.execute("ROLLBACK")
            raise
        self.file.execute("COMMIT")

    def _standing(self, stage: str) -> dict[str, tuple[str, float | None]]:
        return {u: (s, t) for u, s, t in self.file.execute("SELECT unit, state, until FROM standing WHERE stage = ? ORDER BY unit", (stage,))}

    def _write(self, stage: str, unit: str, state: str, until: float | None = None, note: str | None = None) -> None:
        self.file.execute("INSERT INTO entry (written, stage, unit, state, until, note) VALUES (?, ?, ?, ?, ?, ?)", (self.clock(), stage, unit, state, until, note))

    def plan(self, stage: str, units: Iterable[str]) -> list[str]:
        """Open the units that the stage does not know yet; returns these."""
        with self._alone():
            known = self._standing(stage)
            new = sorted(set(units) - set(known))
            for unit in new:
                self._write(stage, unit, "open")
        return new

    def take(self, stage: str, seconds: float = HOLD_SECONDS) -> str | None:
        """Hold the first unit, by name, that is open or was held too long."""
        with self._alone():
            now = self.clock()
            for unit, (state, until) in self._standing(stage).items():
                if state == "open" or (state == "held" and until <= now):
                    self._write(stage, unit, "held", now + seconds)
                    return unit
        return None

    def hold(self, stage: str, unit: str, seconds: float = HOLD_SECONDS) -> bool:
        """Go on holding; False if the unit is not held any more."""
        with self._alone():
            if self._standing(stage).get(unit, ("",))[0] != "held":
                return False
            self._write(stage, unit, "held", self.clock() + seconds)
        return True

    def finish(self, stage: str, unit: str, error: str | None = None) -> None:
        """Done, or failed with an error."""
        self._write(stage, unit, "done" if error is None else "failed", note=error and error[:NOTE_LENGTH])

    def reopen(self, stage: str, unit: str | None = None) -> list[str]:
        """Open a finished unit again, or all failed ones of a stage; returns these.  Held units are left alone."""
        with self._alone():
            ended = ("failed",) if unit is None else ("failed", "done")
            again = [u for u, (state, _) in self._standing(stage).items() if state in ended and unit in (None, u)]
            for u in again:
                self._write(stage, u, "open")
        return again

    def report(self) -> dict[str, dict[str, int]]:
        """Units by stage and state."""
        out: dict[str, dict[str, int]] = {}
        for stage, state, n in self.file.execute("SELECT stage, state, count(*) FROM standing GROUP BY stage, state"):
            out.setdefault(stage, {})[state] = n
        return out

    def state(self, stage: str, unit: str) -> str | None:
        return self._standing(stage).get(unit, (None,))[0]

    def note(self, kind: str, name: str, value: str) -> None:
        """Remember a fact, such as a download's checksum or how far a table reaches; the last one counts."""
        self.file.execute("INSERT INTO fact VALUES (?, ?, ?) ON CONFLICT (kind, name) DO UPDATE SET value = excluded.value", (kind, name, value))

    def facts(self, kind: str) -> dict[str, str]:
        return dict(self.file.execute("SELECT name, value FROM fact WHERE kind = ? ORDER BY name", (kind,)))
