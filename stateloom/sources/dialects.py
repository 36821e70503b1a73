"""Separator, quote and escape of a delimited file, judged by a sample of its records.

Every combination that the sample could be written in parses it. A combination is better the more of what
follows holds, in this order:

1. the header splits and all records are as wide as it; or at least half of them are; or the header is one field
   and so is every record;
2. no field opens with a quote that does not close at the field's end;
3. fields are quoted at all;
4. more records are as wide as the header, the header has more fields, and more fields are quoted.

Ties go to the earlier separator, quote and escape below. A file in which nothing is quoted keeps the
first quote and escape. Lines before the header are not looked for: the first record that is not blank
is the header.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

# Fixed values, in order of preference. An empty quote stands for none.
SEPARATORS = (",", ";", "\t", "|")
QUOTES = (('"', '"'), ('"', "\\"), ("", ""), ("'", "'"), ("'", "\\"))
SAMPLE = 1 << 17  # bytes at the least; a longer header is taken whole
RECORDS = 2000


class Dialect(NamedTuple):
    separator: str = ","
    quote: str = '"'
    escape: str = '"'


class Parsed(NamedTuple):
    widths: list[int]
    quoted: int
    broken: int
    header: str | None


def parse(sample: str, whole: bool, dialect: Dialect, most: int = RECORDS) -> Parsed:
    """Widths of the complete records and what was seen of quotes. `whole`: nothing follows the sample."""
    separator, quote, escape = map(re.escape, dialect)
    bare = re.compile(rf"[^{separator}\r\n]*")
    end = re.compile(rf"{separator}|\r\n|\r|\n|\Z")
    if quote:
        inner = rf"(?:[^{quote}]|{quote}{quote})*+" if dialect.escape == dialect.quote else rf"(?:[^{quote}{escape}]|{escape}.)*+"
        closed = re.compile(rf"{quote}{inner}{quote}(?={separator}|[\r\n]|\Z)", re.DOTALL)
        unclosed = re.compile(rf"{quote}{inner}{escape}?\Z", re.DOTALL)
    widths, quoted, broken, header = [], 0, 0, None
    at, began, width, size = 0, 0, 0, len(sample)
    record_quoted = record_broken = 0
    while at < size and len(widths) < most:
        field = None
        if quote and sample[at] == dialect.quote:
            field = closed.match(sample, at)
            if field is not None and not whole and field.end() == size:
                break  # its last quote may be the first of two
            if field is not None:
                record_quoted += 1
            elif not whole and unclosed.match(sample, at):
                break
            else:
                record_broken += 1
        field = field or bare.match(sample, at)
        width += 1
        stop = end.match(sample, field.end())
        if stop.group() == "" and not whole:
            break
        at = stop.end()
        if stop.group() == dialect.separator:
            if at < size or not whole:
                continue
            width += 1  # the file ends with a separator: one more, empty field
        text = sample[began : field.end() if stop.group() != dialect.separator else at]
        if width > 1 or text:  # blank lines are no records
            if header is None:
                header = text
            widths.append(width)
            quoted, broken = quoted + record_quoted, broken + record_broken
        began, width, record_quoted, record_broken = at, 0, 0, 0
    return Parsed(widths, quoted, broken, header)


def score(parsed: Parsed) -> tuple:
    if not parsed.widths:
        return (-1,)
    width, rows = parsed.widths[0], parsed.widths[1:]
    share = sum(w == width for w in rows) / len(rows) if rows else 1.0
    if width > 1:
        fits = 3 if share == 1 else 2 if share >= 0.5 else -1
    else:
        fits = 1 if share == 1 else 0
    return fits, parsed.broken == 0, parsed.quoted > 0, share, width, parsed.quoted


def candidates(sample: str) -> list[Dialect]:
    """The combinations that can make a difference for this sample, in order of preference."""
    pairs = [p for p in QUOTES if not p[0] or p == QUOTES[0] or (p[0] in sample and (p[1] == p[0] or p[1] + p[0] in sample))]
    return [Dialect(s, *p) for p in pairs for s in SEPARATORS]


def detect(sample: str, whole: bool, wanted: Sequence[Dialect] | None = None) -> tuple[Dialect, str | None]:
    """The best dialect, and the header record; None where the sample ends before it does."""
    tried = [(d, parse(sample, whole, d)) for d in wanted or candidates(sample)]
    best, parsed = max(tried, key=lambda t: score(t[1]))  # the first of equals
    if not parsed.quoted:
        best = best._replace(quote=QUOTES[0][0], escape=QUOTES[0][1]) if not broken_by(tried, best) else best._replace(quote="", escape="")
    return best, parsed.header


def broken_by(tried: list[tuple[Dialect, Parsed]], best: Dialect) -> bool:
    """Whether the first quote would find fields that it opens and does not close."""
    return any(p.broken for d, p in tried if d == (best.separator, *QUOTES[0]))
