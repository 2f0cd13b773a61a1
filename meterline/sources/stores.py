"""Opening files from tasks by the path Spark names them with."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from typing import TypeVar

_PLACE = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)$", re.DOTALL)
# Characters that a path handed to a Spark reader must escape to mean themselves.
_GLOB = re.compile(r"([\\{}\[\]*?])")
# Names that other libraries use for the same stores.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}

ATTEMPTS = 3
PAUSE_SECONDS = 1.0

Result = TypeVar("Result")


def split_path(path: str) -> tuple[str, str, str]:
    """Scheme, authority and the path itself, which is taken as it is: no character of a file name is decoded."""
    match = _PLACE.match(path)
    return (match[1], match[2] or "", match[3]) if match else ("file", "", path)


def literal_path(path: str) -> str:
    """A path as Spark's readers take it without looking for patterns in it."""
    return _GLOB.sub(r"\\\1", path)


def open_store(path: str):
    """The file system that holds ``path``, and the name the path has there."""
    import pyarrow.fs

    scheme, authority, name = split_path(path)
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), name
    store, base = pyarrow.fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{authority}/")
    return store, f"{base.rstrip('/')}{name}"


def retried(action: Callable[[], Result], attempts: int = ATTEMPTS, pause: float = PAUSE_SECONDS) -> Result:
    """The action's result; a failure of the store is tried again and raised in the end."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except OSError:
            if attempt == attempts:
                raise
            time.sleep(pause * attempt)
    raise AssertionError("no attempt was made")
