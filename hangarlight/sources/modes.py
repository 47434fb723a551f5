"""Where a refresh takes its inputs from: freshly fetched, from the cache, or offline, and a cache that knows its files.

Fetching is the caller's: a function that gives a file's bytes, and raises ``Refused`` where the publisher refuses. The
cache keeps each input under its name with a manifest of digests, and gives out no file that has changed since.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Callable
from enum import Enum

from .files import filesystem

log = logging.getLogger(__name__)

Fetch = Callable[[], bytes]


class Mode(Enum):
    FRESH = "fresh"
    CACHE = "cache"
    OFFLINE = "offline"

    @classmethod
    def of(cls, skip_download: bool = False, use_cache: bool = False) -> Mode:
        return cls.OFFLINE if skip_download else cls.CACHE if use_cache else cls.FRESH

    def local(self, explicit: bool, there: bool) -> bool:
        """Whether the file at hand is read: always offline, from the cache where it exists, and where it was named and exists."""
        return (explicit and there) or self is Mode.OFFLINE or (self is Mode.CACHE and there)


class Refused(Exception):
    """The publisher refuses (HTTP 403)."""


class MissingSource(FileNotFoundError):
    """No file to read."""


class ChangedSource(ValueError):
    """A cached file is not the one that was stored."""


def exists(path: str) -> bool:
    from pyarrow import fs

    store, place = filesystem(path)
    return store.get_file_info(place).type != fs.FileType.NotFound


class Cache:
    """A folder of inputs and ``manifest.json`` (name -> sha256, bytes). Files put there by hand have no entry and are read as they are."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.store, self.place = filesystem(self.folder)
        self.store.create_dir(self.place, recursive=True)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def manifest(self) -> dict[str, dict]:
        if not exists(self.path("manifest.json")):
            return {}
        with self.store.open_input_stream(f"{self.place}/manifest.json") as f:
            return json.loads(f.read())

    def _write(self, name: str, data: bytes) -> None:
        """Readers see the old file or the new one."""
        draft = f"{self.place}/.{name}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(draft) as f:
            f.write(data)
        self.store.move(draft, f"{self.place}/{name}")

    def put(self, name: str, data: bytes) -> str:
        self._write(name, data)
        entry = {"sha256": hashlib.sha256(data).hexdigest(), "bytes": len(data)}
        self._write("manifest.json", json.dumps(self.manifest() | {name: entry}, sort_keys=True).encode())
        return self.path(name)

    def get(self, name: str) -> str:
        """The path of a cached file, after its digest was tested."""
        if not exists(self.path(name)):
            raise MissingSource(f"{name} is not in the cache {self.folder}")
        entry = self.manifest().get(name)
        if entry is not None:
            digest = hashlib.sha256()
            with self.store.open_input_stream(f"{self.place}/{name}") as f:
                while part := f.read(1 << 20):
                    digest.update(part)
            if digest.hexdigest() != entry["sha256"]:
                raise ChangedSource(f"{name} in the cache {self.folder} has changed since it was stored")
        return self.path(name)


def resolve(cache: Cache, name: str, mode: Mode, fetch: Fetch | None = None, explicit: str | None = None, others: tuple[str, ...] = ()) -> str:
    """The path to read an input from.

    A named path is read, and must exist. Else a local file is read where the mode says so: ``name`` or the first of ``others``
    (other forms of the input) that is cached. Else it is fetched and cached; where the publisher refuses, what
    is cached under ``name`` stands in.
    """
    if explicit is not None:
        if not exists(explicit):
            raise MissingSource(explicit)
        return explicit
    cached = [n for n in (name, *others) if exists(cache.path(n))]
    if mode.local(False, bool(cached)):
        if not cached:
            raise MissingSource(f"{name} is not in the cache {cache.folder}, and mode {mode.value} does not fetch")
        return cache.get(cached[0])
    if fetch is None:
        raise MissingSource(f"nothing fetches {name}")
    try:
        return cache.put(name, fetch())
    except Refused as refusal:
        if name not in cached:
            raise
        log.warning("%s was refused (%s); the cached file stands in", name, refusal)
        return cache.get(name)
