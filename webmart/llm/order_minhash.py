"""Document fingerprints by Order MinHash.

Every k-mer (``GRAM`` code points) of a text is numbered by its occurrence, so that all are different. Each of ``SKETCHES``
orders, given by a hash, selects the ``PICKED`` least of them; these are put back into text order and their tuple is
hashed. Two texts agree in a sketch about as often as they share k-mers in the same order, which follows edit distance
more closely than shared k-mers alone. Likeness is the share of sketches that agree.

``edited_pairs`` fingerprints each document beside an edited text, its last third replaced by the start of the document
with the next lower id. Rows are spread over id ranges by quantiles of the ids, each range sorted and read in one pass that
holds two texts at a time; the top row of each range is copied to the range above it. Texts are shuffled once.

Null text counts as empty. A text shorter than a k-mer is one k-mer; an empty text has the fingerprint of no k-mers, and
equal texts have equal fingerprints and likeness 1. Rows are ordered by doc_id downwards, then by the hash of the text;
rows without doc_id come last. A single row is its own next. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmart.llm.common import arrow_schema, in_batches

GRAM, SKETCHES, PICKED = 8, 32, 2
_CHUNK = 2048
_draw = np.random.default_rng(31)
_MULTIPLY = _draw.integers(0, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _draw.integers(0, 2**63, SKETCHES, dtype=np.uint64)
_ROLL = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(2**64 - 1)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xA3B195354A39B70D)
    return values ^ (values >> np.uint64(32))


def codes(text: str | None) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")


def numbered_grams(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash for each k-mer and its number among equal ones, in text order."""
    if not len(points):
        return np.zeros(0, dtype=np.uint64)
    size = min(gram, len(points))
    value = np.zeros(len(points) - size + 1, dtype=np.uint64)
    wide = points.astype(np.uint64)
    for k in range(size):
        value *= _ROLL
        value += wide[k : k + len(value)]
    value = _mix(value + np.uint64(size))
    ordered = np.sort(value)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(again):
        marked = np.zeros(1 << 16, dtype=bool)  # finds all that occur again, and a few others
        marked[again & np.uint64(0xFFFF)] = True
        places = np.flatnonzero(marked[value & np.uint64(0xFFFF)])
        some = value[places]
        order = np.argsort(some, kind="stable")
        new = np.concatenate([[True], some[order][1:] != some[order][:-1]])
        run = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        number = np.empty(len(order), dtype=np.uint64)
        number[order] = run
        value[places] = np.where(number > 0, _mix(some + number * np.uint64(0x2545F4914F6CDD1D)), some)
    return value


Picks = tuple[np.ndarray, np.ndarray, np.ndarray]


def pick(grams: np.ndarray, begin: int = 0, end: int | None = None) -> Picks:
    """For each order the least k-mers of a stretch: their ranks, places and hashes; fewer are filled with the last rank."""
    ranks, places, hashes = [], [], []
    row = np.arange(SKETCHES)
    for at in range(begin, len(grams) if end is None else end, _CHUNK):
        part = grams[at : min(at + _CHUNK, len(grams) if end is None else end)]
        rank = (part[None, :] ^ _SHIFT[:, None]) * _MULTIPLY[:, None]
        for _ in range(min(PICKED, len(part))):
            least = rank.argmin(axis=1)
            ranks.append(rank[row, least])
            places.append(least + at)
            hashes.append(part[least])
            rank[row, least] = _LAST
    if not ranks:
        none = np.zeros((0, SKETCHES))
        return none.astype(np.uint64), none.astype(np.int64), none.astype(np.uint64)
    return np.array(ranks), np.array(places), np.array(hashes)


def sketch(*parts: Picks) -> np.ndarray:
    """Hashes of the tuples that the stretches of a text have together."""
    ranks, places, hashes = (np.concatenate(group) for group in zip(*parts))
    found = np.zeros(SKETCHES, dtype=np.uint64)
    if len(ranks):
        column = np.arange(SKETCHES)
        least = np.argsort(ranks, axis=0, kind="stable")[:PICKED]
        order = np.take_along_axis(least, np.argsort(places[least, column], axis=0), axis=0)
        for chosen in order:
            found = _mix(found * _ROLL + hashes[chosen, column])
    return found >> np.uint64(48)


def text_of(found: np.ndarray) -> str:
    """A fingerprint as four hexadecimal digits for each sketch."""
    return found.astype(">u2").tobytes().hex()


def fingerprint(text: str | None) -> np.ndarray:
    return sketch(pick(numbered_grams(codes(text))))


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    return float(np.mean(left == right))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many code points of the following one, or all it has."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


class _Document:
    """A text with its k-mers and fingerprint; the least k-mers of its first two thirds are kept for the edited text."""

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.points = codes(self.text)
        self.stay = len(self.points) - len(self.points) // 3
        grams = numbered_grams(self.points)
        self.shared = max(0, self.stay - GRAM + 1)
        self.first = pick(grams, 0, self.shared)
        self.print = sketch(self.first, pick(grams, self.shared))

    def beside(self, following: _Document) -> tuple:
        changed = edited(self.text, following.text)
        grams = numbered_grams(np.concatenate([self.points[: self.stay], following.points[: len(self.points) // 3]]))
        if changed == self.text:
            other = self.print
        elif len(grams) >= self.shared and self.shared:
            other = sketch(self.first, pick(grams, self.shared))
        else:
            other = sketch(pick(grams))
        return (
            self.doc_id,
            len(self.points),
            hashlib.sha256(changed.encode("utf-8")).hexdigest(),
            text_of(self.print),
            text_of(other),
            likeness(self.print, other),
            likeness(self.print, following.print),
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and the fingerprint of its text."""
    def start():
        def apply(columns):
            return {"doc_id": columns["doc_id"], "fingerprint": [text_of(fingerprint(t)) for t in columns["text"]]}

        return apply

    return in_batches(docs.select("doc_id", "text"), "doc_id long, fingerprint string", start)


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows with the number of their id range, ranges counted downwards; and how many there are."""
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / count for k in range(1, count)]
    bounds = sorted(set(docs.approxQuantile("doc_id", shares, 0.1 / count))) if shares else []
    above = F.size(F.filter(F.lit([int(b) for b in bounds]) if bounds else F.array().cast("array<bigint>"),
                            lambda bound: bound >= F.col("doc_id")))
    text_hash = F.xxhash64("text")
    unnamed = F.shiftright(text_hash, 60) + len(bounds) + 9  # sixteen ranges by the hash of the text
    part = F.when(F.col("doc_id").isNull(), unnamed.cast("int")).otherwise(above)
    return docs.select("doc_id", "text", part.alias("part"), text_hash.alias("text_hash")), len(bounds) + 17


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Per row: the digests of :data:`RESULT` for its text, its edited text and the next document."""
    rows, ranges = _in_ranges(docs.select("doc_id", "text"))
    order = F.struct((-F.col("doc_id")).alias("down"), "text_hash")
    tops = rows.groupBy("part").agg(F.min(order).alias("top")).select("part", "top.*").orderBy("part").collect()
    if not tops:
        return docs.sparkSession.createDataFrame([], RESULT)
    # one row for each range: the range above it, or the last range for the first, reads it after its own rows
    goes_to = [
        (None if top.down is None else -top.down, top.text_hash, top.part, tops[k - 1].part) for k, top in enumerate(tops)
    ]
    keys = docs.sparkSession.createDataFrame(goes_to, "top_id long, top_hash long, own int, part int")
    same = F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("text_hash") == F.col("top_hash")) & (F.col("r.part") == F.col("own"))
    copies = rows.alias("r").join(F.broadcast(keys.alias("k")), same).select("doc_id", "text", "k.part", "text_hash")
    copies = copies.dropDuplicates(["part"]).withColumn("copied", F.lit(True))
    spread = rows.withColumn("copied", F.lit(False)).unionByName(copies).repartitionById(ranges, F.col("part"))
    ordered = spread.sortWithinPartitions("part", "copied", F.desc_nulls_last("doc_id"), "text_hash")

    arrow = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: _Document | None = None
        part_of_waiting = None
        for batch in batches:
            made: list[tuple] = []
            columns = [batch.column(name) for name in ("doc_id", "text", "part", "copied")]
            for k in range(batch.num_rows):
                doc_id, text, part, copied = (column[k].as_py() for column in columns)
                now = _Document(doc_id, text)
                if waiting is not None and part == part_of_waiting:
                    made.append(waiting.beside(now))
                waiting, part_of_waiting = (None if copied else now), part
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in made], type=field.type) for i, field in enumerate(arrow)], schema=arrow
            )

    return ordered.select("doc_id", "text", "part", "copied").mapInArrow(run, RESULT)
