"""Archives from a source outside: a listing and a stream of bytes, by whatever transport is given."""

from __future__ import annotations

import hashlib
import json
import os
import urllib.request
from collections.abc import Iterator
from pathlib import Path
from typing import Protocol

from . import filenames

CHUNK = 1 << 20


class Transport(Protocol):
    def listing(self) -> dict[str, int]:
        """Size by name of what is offered."""

    def read(self, name: str) -> Iterator[bytes]: ...


class Http:
    """A server that gives its listing as JSON, {name: size}, and each file under its name."""

    def __init__(self, base: str, index: str = "index.json", timeout: float = 60):
        self.base, self.index, self.timeout = base.rstrip("/"), index, timeout

    def _open(self, name: str):
        return urllib.request.urlopen(f"{self.base}/{name}", timeout=self.timeout)

    def listing(self) -> dict[str, int]:
        with self._open(self.index) as f:
            return json.load(f)

    def read(self, name: str) -> Iterator[bytes]:
        with self._open(name) as f:
            while chunk := f.read(CHUNK):
                yield chunk


def fetched(transport: Transport, folder: str, journal=None) -> list[str]:
    """Fetch what a build needs and the folder lacks; returns the new names.

    A file appears under its name only when it is whole.  Its checksum goes to the journal.
    """
    os.makedirs(folder, exist_ok=True)
    sizes = transport.listing()
    new = filenames.missing(sizes, os.listdir(folder))
    for name in new:
        part, digest, n = Path(folder, f"{name}.part"), hashlib.sha256(), 0
        with open(part, "wb") as f:
            for chunk in transport.read(name):
                f.write(chunk)
                digest.update(chunk)
                n += len(chunk)
        if n != sizes[name]:
            part.unlink()
            raise OSError(f"{name}: {n} of {sizes[name]} bytes")
        os.replace(part, Path(folder, name))
        if journal is not None:
            journal.note("download", name, digest.hexdigest())
    return new
