"""Digest, header and dialect of files, each read as a stream in bounded memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import numpy as np
import pandas as pd

from stateloom.sources.dialects import SAMPLE, Dialect, detect

CHUNK = 1 << 22
NEWLINE, RETURN = 10, 13
# what a quote that opens or closes a field stands next to: a separator, or the end of a line
EDGES = np.zeros(256, bool)
EDGES[[ord(c) for c in ",;\t|\r\n"]] = True


def open_stream(path: str):
    """A file of any file system Arrow knows, by the path Spark lists it under."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_stream("/" + path[len("file:") :].lstrip("/"))
    if "://" not in path:
        return fs.LocalFileSystem().open_input_stream(path)
    system, inner = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_stream(inner)


class Scanned(NamedTuple):
    md5: str
    header: str
    separator: str
    quote: str
    escape: str
    quoted_breaks: bool


class Breaks:
    """Whether a line break sits inside quotes; only quotes at the edge of a field count, so that a stray one inside a value does not."""

    def __init__(self, dialect: Dialect) -> None:
        self.quote = ord(dialect.quote) if dialect.quote else -1
        # an escaped quote looks like one at an edge: such files are taken to hold breaks
        self.escaped = dialect.quote != "" and dialect.escape != dialect.quote
        self.held = b"\n"  # the byte before the next chunk and, but at the start, one that waits for its successor
        self.inside = False
        self.found = False

    def take(self, chunk: bytes) -> None:
        if self.found or self.quote < 0:
            return
        if self.escaped:
            self.found = self.quote in chunk
            return
        codes = np.frombuffer(self.held + (chunk or b"\n"), np.uint8)
        edge = (codes[1:-1] == self.quote) & (EDGES[codes[:-2]] | EDGES[codes[2:]])
        open_ = (np.cumsum(edge) + self.inside) & 1
        self.found = bool((open_[codes[1:-1] == NEWLINE] | 0).any() or (open_[codes[1:-1] == RETURN] | 0).any())
        self.inside = bool(open_[-1]) if len(open_) else self.inside
        self.held = codes[-2:].tobytes()


def scan_file(path: str) -> Scanned:
    """Digest, header record, dialect and quoted line breaks in one pass in bounded memory.

    The dialect is judged by the first SAMPLE bytes, or by as many as the header takes.
    """
    digest, sample, need, breaks = hashlib.md5(), bytearray(), SAMPLE, None
    dialect, header = Dialect(), ""
    with open_stream(path) as stream:
        while True:
            chunk = stream.read(CHUNK)
            digest.update(chunk)
            if breaks is not None:
                breaks.take(chunk)
            else:
                sample += chunk
                if len(sample) >= need or not chunk:
                    dialect, found = detect(as_text(bytes(sample), not chunk), not chunk)
                    if found is not None or not chunk:
                        header, breaks = found or "", Breaks(dialect)
                        breaks.take(bytes(sample))
                        if not chunk:
                            breaks.take(b"")
                        sample = bytearray()
                    else:
                        need = 2 * len(sample)
            if not chunk:
                return Scanned(digest.hexdigest(), header, *dialect, breaks.found)


def as_text(sample: bytes, whole: bool) -> str:
    """Without byte-order mark, and without a character that is cut off."""
    if not whole:
        cut = len(sample)
        while cut > 0 and len(sample) - cut < 4 and sample[cut - 1] & 0xC0 == 0x80:
            cut -= 1
        if cut and sample[cut - 1] >= 0xC0:
            sample = sample[: cut - 1]
    return sample.decode("utf-8", "replace").removeprefix("\ufeff")


def scan_batches(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        scanned = [scan_file(path) for path in batch["path"]]
        yield batch.assign(**{field: [s[i] for s in scanned] for i, field in enumerate(Scanned._fields)})
