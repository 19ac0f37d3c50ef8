import hashlib
import random
import re
import zlib

import pytest

from webmart.llm import secret_scan
from webmart.llm.queries import op6_secrets

ASSIGN = re.compile(
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
    "[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base(text):
    """The base spans by plain scans of the whole text."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def checked_token(prefix, body):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = secret_scan._BASE62[digit] + digits
    return f"{prefix}_{body}{digits}"


def test_base_spans_equal_plain_scans():
    draw = random.Random(3)
    bits = ["password", "PassWd", "SECRET", "token", "toKen", "api_key", "apikey", "AKIA", "=", ":", " ", '"', "'", "a1b2",
            "0123456789abcdef", "f" * 31, "g", "XYZ0", "é", "İ", "ſecret", "toKen", "\n", "ghp_", "0" * 70]
    for _ in range(20000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 12)))
        found = [span for span in secret_scan.find_spans(text) if span[0] in secret_scan.BASE_KINDS]
        assert found == base(text), text


def test_hex_runs_at_every_offset():
    for size in (31, 32, 33, 47, 48, 64, 200):
        for offset in range(40):
            text = "x" * offset + "ab1" * 100
            text = text[: offset + size] + "x tail"
            assert secret_scan.find_spans(text) == base(text)


def test_tokens_need_their_checksum():
    good = checked_token("ghp", "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5")
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    npm = checked_token("npm", "0" * 30)
    assert [s[0] for s in secret_scan.find_spans(f"see {good}, {bad} and {npm}.")] == ["github", "npm"]
    assert secret_scan.find_spans(good + "Z") == []


def test_redaction_joins_overlaps():
    text = "token=" + "0123456789abcdef" * 2 + " end"
    assert [s[0] for s in secret_scan.find_spans(text)] == ["assign", "hex"]
    assert secret_scan.redact(text, secret_scan.find_spans(text)) == "[assign] end"
    assert secret_scan.redact(None, []) is None


def expected(rows):
    out = []
    for row in rows:
        spans = base(row.text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        counts = [sum(k == kind for k, _, _ in spans) for kind in secret_scan.BASE_KINDS]
        out.append((row.doc_id, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_equals_plain_scans(spark, sf_dir):
    found = op6_secrets(spark, sf_dir)
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sorted((tuple(row)[:5] for row in found.collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_odd_rows(request, name):
    docs = request.getfixturevalue(name)
    found = secret_scan.span_digests(secret_scan.scan_secrets(docs)).collect()
    assert sorted((tuple(row)[:5] for row in found), key=repr) == expected(docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_redaction_keeps_rows_and_columns(request, name):
    docs = request.getfixturevalue(name)
    redacted = secret_scan.redact_secrets(docs)
    assert redacted.columns == docs.columns
    assert sorted(map(repr, redacted.collect())) == sorted(map(repr, docs.collect()))
