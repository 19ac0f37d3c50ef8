import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from webmart.llm import simhash
from webmart.llm.queries import op4_simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """{fingerprint: root} by comparing all pairs."""
    nodes = sorted(set(prints))
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {node: find(node) for node in nodes}


def expected(rows):
    prints = [plain_fingerprint(row.text) for row in rows]
    root = groups(prints)
    least = {}
    for row, value in zip(rows, prints):
        if row.doc_id is not None:
            least[root[value]] = min(least.get(root[value], row.doc_id), row.doc_id)
    return sorted(((r.doc_id, f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints)), key=repr)


@pytest.mark.parametrize("name", ["documents", "odd", "none", "clashing"])
def test_equals_all_pairs(request, name):
    docs = request.getfixturevalue(name)
    found = simhash.near_duplicates(docs).collect()
    assert sorted(map(tuple, found), key=repr) == expected(docs.select("doc_id", "text").collect())


def test_query_equals_all_pairs(spark, sf_dir):
    found = op4_simhash(spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("crowd", [2, 64])
def test_chains_and_crowds(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    draw = random.Random(9)
    prints = [0, -1]
    for _ in range(40):
        value = draw.getrandbits(64)
        for _ in range(draw.randint(1, 12)):
            prints.append(simhash._signed(value))
            for _ in range(draw.randint(1, 3)):
                value ^= 1 << draw.randrange(64)
    rows = list(enumerate(prints))
    draw.shuffle(rows)
    found = simhash.components(spark.createDataFrame(rows, "doc_id long, print long")).collect()
    root = groups([p & (1 << 64) - 1 for p in prints])
    least = {}
    for i, p in enumerate(prints):
        least.setdefault(root[p & (1 << 64) - 1], i)
    assert {r.doc_id: r.component_id for r in found} == {i: least[root[p & (1 << 64) - 1]] for i, p in enumerate(prints)}


def test_long_chain(spark):
    gray = [simhash._signed((n ^ n >> 1) << 40) for n in range(1500)]
    rows = [(n * 7919 % 1500, gray[n]) for n in range(1500)]
    found = simhash.components(spark.createDataFrame(rows, "doc_id long, print long")).collect()
    assert len(found) == 1500 and {row.component_id for row in found} == {0}


def test_one_document_of_each_group_stays(odd, clashing, none):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    roots = {root for _, _, root in expected(odd.collect()) if root is not None}
    assert sorted(row.doc_id for row in kept.collect() if row.doc_id is not None) == sorted(roots)
    assert sum(row.doc_id is None for row in kept.collect()) == 2
    assert simhash.one_of_each(clashing).columns == clashing.columns
    assert simhash.one_of_each(none).count() == 0


def test_no_group_is_lost_where_an_id_has_several_texts(spark):
    x, y = "a text of some words that are its own", "and another one, with nothing in common"
    rows = [(5, x), (7, x), (5, y), (3, y), (9, x), (5, y), (None, x)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(5, x), (3, y), (None, x)], key=repr)


def test_crowded_blocks_join_in_a_way_that_spark_splits(spark, monkeypatch):
    """The frame that the crowd's join reads is a saved table on either side, not an aggregate in the same stage."""
    seen = []
    real = simhash.saved
    monkeypatch.setattr(simhash, "saved", lambda frame: seen.append(frame) or real(frame))
    prints = spark.range(300).select(F.col("id").alias("print"))
    simhash.links(real(simhash.pivot_table(prints)))
    joined = seen[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in joined and "Aggregate" not in joined
