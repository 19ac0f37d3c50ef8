import pytest

from webmart.llm import line_dedup
from webmart.llm.queries import op1_line_dedup


def expected(rows):
    """(doc_id, text, removed spans) by one pass in order of rank."""
    seen, out = {}, []
    order = sorted({(r.doc_id is None, r.doc_id or 0, r.text) for r in rows if r.text is not None}, key=lambda r: r[:2])
    removed = {}
    for unknown, doc_id, text in order:
        spans, at = [], 0
        for line in text.split("\n"):
            words = line.lower().split()
            if len(words) >= line_dedup.LEAST_WORDS:
                if tuple(words) in seen:
                    spans.append((at, at + len(line)))
                seen[tuple(words)] = True
            at += len(line) + 1
        removed[unknown, doc_id, text] = spans
    for row in rows:
        spans = removed.get((row.doc_id is None, row.doc_id or 0, row.text), [])
        text, at, parts = row.text, 0, []
        for start, end in spans:
            parts.append(text[at:start])
            at = min(end + 1, len(text))
        out.append((row.doc_id, None if text is None else "".join(parts) + text[at:], spans))
    return sorted(out, key=repr)


def plain(rows):
    return sorted(((r.doc_id, r.text, [(s.start, s.end) for s in r.removed]) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["documents", "odd", "none", "clashing"])
def test_equals_one_pass(request, name):
    docs = request.getfixturevalue(name)
    found = line_dedup.without_repeats(docs).collect()
    assert plain(found) == expected(docs.select("doc_id", "text").collect())


def test_query_keeps_offsets(spark, sf_dir):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op1_line_dedup(spark, sf_dir).collect()
    assert plain(found) == expected(spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    for row in found:
        assert row.n_removed == len(row.removed)
        assert "".join(rows[row.doc_id][s.start : s.end] for s in row.kept) == row.text


def test_case_and_spaces_do_not_count(spark):
    rows = [(2, "ONE  two three\tfour five\nshort line"), (1, "one two three four five\nshort line")]
    found = line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {row.doc_id: row.text for row in found} == {1: rows[1][1], 2: "short line"}


def test_a_crowded_digest_is_joined_in_a_way_that_spark_splits(spark, monkeypatch):
    """Both sides of the join by digest are saved tables; no aggregate stands in its stage."""
    seen = []
    real = line_dedup.saved
    monkeypatch.setattr(line_dedup, "saved", lambda frame: seen.append(frame) or real(frame))
    rows = [(n, "one line of five words or more\nand its own number " + "x" * n) for n in range(50)]
    later = line_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(seen) == 3 and later.count() == 49
    joined = later._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count("Aggregate") == 1 and joined.index("Aggregate") < joined.index("Join")
