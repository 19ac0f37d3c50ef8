"""Secret scans: a keyword prefilter, expressions anchored at its hits, and embedded checksums.

One Aho-Corasick pass over a lower-cased text finds the keywords of all kinds. An expression is tried only where a
keyword of its kind begins, and matches of a kind do not overlap: a hit inside an earlier match of its kind is passed
over. Hexadecimal secrets have no keyword; as they are 32 characters or longer, every sixteenth character is probed, and
only a run of hexadecimal digits around a probe is measured. Tokens with an embedded CRC-32 count only if it agrees.

Positions are code points, ends exclusive. Null text counts as empty, and an empty text has no span. Rows are
independent: repeated rows repeat their result; other columns are ignored. Work and memory are in proportion to a text.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmart.llm.common import Columns, in_batches

BASE_KINDS = ("assign", "access", "hex")
PROBE = 16
_BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
_HEX = "0123456789abcdef"
SPANS = "array<struct<kind: string, start: int, end: int>>"
Span = tuple[str, int, int]


def crc32_agrees(token: str) -> bool:
    """Whether the last six characters are the CRC-32, in base 62, of those between the prefix and them."""
    body, digits = token.partition("_")[2][:-6], token[-6:]
    value = 0
    for digit in digits:
        value = value * 62 + _BASE62.index(digit)
    return value == zlib.crc32(body.encode("ascii"))


@dataclass(frozen=True)
class Kind:
    """A kind of secret: keywords in lower case, an expression that starts with one, and a test of its match."""

    name: str
    keywords: tuple[str, ...]
    expression: re.Pattern[str]
    valid: object


KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(
            r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
        ),
        lambda match: len(match[2]) >= 8,
    ),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda match: len(match[0]) >= 16),
    Kind(
        "github",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
        lambda match: crc32_agrees(match[0]),
    ),
    Kind(
        "npm",
        ("npm_",),
        re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
        lambda match: crc32_agrees(match[0]),
    ),
)
#: The order of kinds that begin at the same place.
ORDER = {name: place for place, name in enumerate((*BASE_KINDS, "github", "npm"))}


@lru_cache(maxsize=1)
def _finder() -> ahocorasick.Automaton:
    finder = ahocorasick.Automaton()
    for kind in KINDS:
        for word in kind.keywords:
            finder.add_word(word, (kind, len(word)))
    finder.make_automaton()
    return finder


def _lower(text: str) -> str:
    """Lower case with every character in its place."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def _hex_runs(text: str, least: int = 32) -> Iterator[Span]:
    """Whole runs of lower-case hexadecimal digits of at least ``least`` characters."""
    probes = text[PROBE - 1 :: PROBE]
    passed = 0
    # a run of 32 covers two probes that follow each other; probes that follow each other may lie in several runs
    for match in re.finditer(f"[{_HEX}]{{{least // PROBE},}}", probes):
        for start in range(match.start() * PROBE + PROBE - 1, match.end() * PROBE, PROBE):
            if start < passed:
                continue
            before = start
            while before > passed:  # back to the start of the run
                chunk = text[max(passed, before - 64) : before]
                rest = len(chunk.rstrip(_HEX))
                before -= len(chunk) - rest
                if rest:
                    break
            passed = _HEX_RUN.match(text, before).end()
            if passed - before >= least:
                yield "hex", before, passed


_HEX_RUN = re.compile(f"[{_HEX}]*")


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text by start, then by kind."""
    if not text:
        return []
    spans: list[Span] = []
    passed = dict.fromkeys(ORDER, 0)
    for last, (kind, size) in _finder().iter(_lower(text)):
        start = last + 1 - size
        if start < passed[kind.name]:
            continue
        match = kind.expression.match(text, start)
        if match is None:
            continue
        passed[kind.name] = match.end()
        if kind.valid(match):
            spans.append((kind.name, start, match.end()))
    spans.extend(_hex_runs(text))
    spans.sort(key=lambda span: (span[1], ORDER[span[0]]))
    return spans


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span, overlapping ones as one, replaced by the kind of its first in square brackets."""
    if not text or not spans:
        return text
    out, passed = [], 0
    for kind, start, end in spans:
        if start >= passed:
            out.append(text[passed:start])
            out.append(f"[{kind}]")
        passed = max(passed, end)
    out.append(text[passed:])
    return "".join(out)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and the spans found in its text."""

    def start():
        def apply(columns: Columns) -> Columns:
            found = [
                [{"kind": kind, "start": start, "end": end} for kind, start, end in find_spans(text)]
                for text in columns["text"]
            ]
            return {"doc_id": columns["doc_id"], "spans": found}

        return apply

    return in_batches(docs.select("doc_id", "text"), f"doc_id long, spans {SPANS}", start)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The same rows and columns, with the secrets in ``text`` replaced by their kind."""

    def start():
        def apply(columns: Columns) -> Columns:
            columns["text"] = [redact(text, find_spans(text)) for text in columns["text"]]
            return columns

        return apply

    return in_batches(docs, docs.schema, start)


def span_digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, sha256 of the base spans and all spans as text, from the spans of :func:`scan_secrets`."""

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return scanned.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
