"""Files of a dataset at a fixed revision, from a folder or over https, into a folder that all executors share.

A file that is there is not fetched again; one that is fetched appears under its name at once and whole. Many files are
fetched in parallel, one to a row.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import BinaryIO
from urllib.error import HTTPError
from urllib.parse import quote, urlparse
from urllib.request import urlopen

import pyarrow as pa
from pyspark.sql import DataFrame


class NotUpstream(FileNotFoundError):
    """There is no such file at this revision."""


@dataclass(frozen=True)
class Upstream:
    """`uri` is a folder, file:// or https://; `{revision}` and `{path}` in an https address are filled in, and without
    them the path goes behind the address."""

    source_id: str
    uri: str
    revision: str = "main"
    cache: str = ""
    timeout: float = 60.0

    @property
    def folder(self) -> str | None:
        if "://" not in self.uri:
            return self.uri
        return urlparse(self.uri).path if self.uri.startswith("file://") else None

    def address(self, path: str) -> str:
        if urlparse(self.uri).scheme != "https":
            raise ValueError(f"{self.uri} is neither a folder nor https")
        if "{path}" in self.uri:
            return self.uri.replace("{revision}", quote(self.revision)).replace("{path}", quote(path))
        return f"{self.uri.rstrip('/')}/{quote(path)}"

    @contextmanager
    def stream(self, path: str) -> Iterator[BinaryIO]:
        """A file to read from its start, as far as is needed."""
        try:
            with open(os.path.join(self.folder, path), "rb") if self.folder is not None else urlopen(self.address(path), timeout=self.timeout) as f:
                yield f
        except FileNotFoundError as e:
            raise NotUpstream(path) from e
        except HTTPError as e:
            raise NotUpstream(path) if e.code == 404 else e from e

    def local(self, path: str) -> str:
        """The place of a file: in the folder itself, or in the cache, fetched on first use."""
        if self.folder is not None:
            place = os.path.join(self.folder, path)
            if not os.path.exists(place):
                raise NotUpstream(path)
            return place
        place = os.path.join(self.cache, self.source_id, self.revision, path)
        if not os.path.exists(place):
            os.makedirs(os.path.dirname(place), exist_ok=True)
            part = f"{place}.{uuid.uuid4().hex}.tmp"
            try:
                with self.stream(path) as f, open(part, "wb") as out:
                    shutil.copyfileobj(f, out)
                os.replace(part, place)
            finally:
                if os.path.exists(part):
                    os.remove(part)
        return place

    def has(self, path: str) -> bool:
        try:
            self.local(path)
        except NotUpstream:
            return False
        return True


def fetch_all(files: DataFrame, upstream: Upstream, path: str = "path") -> DataFrame:
    """(path, place, error) of every file asked for; a file that is not there or cannot be had is told, not fatal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                place = error = None
                try:
                    place = upstream.local(name)
                except OSError as e:
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([place], pa.string()), pa.array([error], pa.string())], names=["path", "place", "error"])

    return files.select(path).mapInArrow(run, "path string, place string, error string")
