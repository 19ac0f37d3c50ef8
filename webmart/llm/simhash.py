"""SimHash near-duplicates found through pivot distance tables.

``fingerprints`` gives each text 64 bits, each the majority of that bit over the hashes of its word shingles.
``components`` links fingerprints that differ in at most two bits and numbers the connected groups:

1. Equal fingerprints become one. For each, a table holds its Hamming distances to sixteen reference fingerprints.
2. Of four blocks of sixteen bits, two at least are the same in a linked pair. Fingerprints that agree in two blocks
   meet; a pair whose distances to any reference differ by more than two cannot be linked and is discarded; the
   survivors are compared bit by bit.
3. Where more than ``CROWD`` fingerprints meet, pairs would grow with the square of their number. Those fingerprints are
   linked through the values one bit away from them instead: two fingerprints differ in at most two bits exactly
   if they share such a value or one is such a value of the other. This loses no link, so the groups are the same.
4. Groups are followed by rounds of neighbour exchange (large star, small star), each saved to the shared folder.

Null text counts as empty; texts without words have fingerprint zero, linked like any other. Repeated rows repeat their
result. Rows without doc_id take part, but never name a group unless all its rows lack one. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from webmart.llm.common import Columns, columns_of, fresh, in_batches, saved

WORDS = 3
SEED = 42
BITS = 64
LINKED = 2
BLOCKS = 4
#: Fingerprints that may meet in two equal blocks before the one-bit neighbours take over.
CROWD = 64


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


_random = random.Random(20)
#: The reference fingerprints, drawn once from a fixed seed.
PIVOTS = tuple(_signed(_random.getrandbits(BITS)) for _ in range(16))


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits over XXH64 of the word shingles; ASCII letters in lower case, ASCII white space between words."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    starts, at = [], 0
    for word in found:
        starts.append(at)
        at += len(word) + 1
    starts.append(at)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[words:])]
    bits = np.zeros(BITS, dtype=np.int64)
    values = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    for begin in range(0, len(values), 4096):
        bits += np.unpackbits(values[begin : begin + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, a hash of the text, and the fingerprint as a signed long."""

    def start():
        def apply(columns: Columns) -> Columns:
            prints = [_signed(fingerprint(text, words)) for text in columns["text"]]
            return {"doc_id": columns["doc_id"], "text_hash": columns["text_hash"], "print": prints}

        return apply

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return in_batches(rows, "doc_id long, text_hash long, print long", start)


def _distance(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))


def _mask(blocks: tuple[int, ...]) -> int:
    size = BITS // BLOCKS
    return _signed(sum(((1 << size) - 1) << size * block for block in blocks))


def pivot_table(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints with their distances to the reference fingerprints."""
    distances = [_distance(F.col("print"), F.lit(pivot)).cast("tinyint") for pivot in PIVOTS]
    return prints.select("print").distinct().withColumn("distances", F.array(*distances))


def links(table: DataFrame) -> DataFrame:
    """Pairs (a, b) of fingerprints whose connected groups are those of all pairs within two bits."""
    choices = list(combinations(range(BLOCKS), BLOCKS - LINKED))
    blocks = F.array(
        *[
            F.struct(F.lit(k).cast("tinyint").alias("k"), F.col("print").bitwiseAND(F.lit(_mask(c))).alias("bits"))
            for k, c in enumerate(choices)
        ]
    )
    met = table.select("print", "distances", F.explode(blocks).alias("block")).select("print", "distances", "block.*")
    # saved, so that the join below is one of two plain shuffles, which Spark splits where a block is crowded
    sizes = saved(met.groupBy("k", "bits").agg(F.count("*").alias("n")).where("n > 1"))
    grouped = saved(met.join(sizes, ["k", "bits"]))
    few = grouped.where(F.col("n") <= CROWD)
    near = F.forall(
        F.zip_with("a.distances", "b.distances", lambda x, y: F.abs(x.cast("int") - y.cast("int"))),
        lambda gap: gap <= LINKED,
    )
    same = (F.col("a.k") == F.col("b.k")) & (F.col("a.bits") == F.col("b.bits"))
    pairs = (
        few.alias("a")
        .join(few.alias("b"), same & (F.col("a.print") < F.col("b.print")) & near)
        .where(_distance(F.col("a.print"), F.col("b.print")) <= LINKED)
        .select(F.col("a.print").alias("a"), F.col("b.print").alias("b"))
    )
    crowded = grouped.where(F.col("n") > CROWD).select("print").distinct()
    values = [F.col("print"), *[F.col("print").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(BITS)]]
    beside = crowded.select("print", F.explode(F.array(*values)).alias("value"))
    least = beside.groupBy("value").agg(F.min("print").alias("a"), F.count("*").alias("n")).where("n > 1")
    through = beside.join(least, "value").select("a", F.col("print").alias("b")).where("a <> b")
    return pairs.union(through).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b), the root being the least node of its group."""
    edges = saved(edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct())
    before = None
    while True:
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("root"))
        # large star: greater neighbours are tied to the least one
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        # small star: a node and its lesser neighbours are tied to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("root"))
        tied = large.join(low, "a")
        small = tied.select(F.col("b").alias("a"), F.col("root").alias("b")).union(low.select("a", F.col("root").alias("b")))
        edges = saved(small.where("a <> b").distinct())
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")


def _rooted(prints: DataFrame) -> DataFrame:
    """Per distinct fingerprint: print, the least doc_id that has it, and the root of its group."""
    roots = connected(links(saved(pivot_table(prints))))
    least = prints.groupBy("print").agg(F.min("doc_id").alias("doc_id"))
    return least.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "doc_id", F.coalesce("root", "print").alias("root")
    )


def components(prints: DataFrame) -> DataFrame:
    """Rows (doc_id, print) with component_id, the smallest doc_id reachable over links."""
    prints = saved(prints.select("doc_id", "print"))
    named = _rooted(prints)
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = named.select("print", "root").join(ids, "root").select("print", "component_id")
    return prints.join(labels, "print").select("doc_id", "print", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint in 16 hexadecimal digits, component_id."""
    found = components(fingerprints(docs))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, all columns kept: the one of the smallest doc_id and, of those, the lowest text hash.

    Rows alike in doc_id and text are one document. Rows without doc_id stay, as they cannot be told apart.
    """
    prints = saved(fingerprints(docs))
    who = F.struct("doc_id", "text_hash")
    known = prints.where("doc_id IS NOT NULL").join(_rooted(prints).select("print", "root"), "print")
    first = saved(known.groupBy("root").agg(F.min(who).alias("first")))
    dropped = known.join(first, "root").where(who != F.col("first")).select("doc_id", "text_hash").distinct()
    text_hash, salt, rank = fresh(docs, "text_hash"), fresh(docs, "salt"), fresh(docs, "rank")
    marked = docs.withColumn(text_hash, F.xxhash64("text"))
    kept = marked.join(dropped.withColumnRenamed("text_hash", text_hash), ["doc_id", text_hash], "left_anti")
    order = Window.partitionBy("doc_id", text_hash, salt).orderBy(text_hash)
    salted = kept.withColumn(salt, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return salted.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*columns_of(docs))
