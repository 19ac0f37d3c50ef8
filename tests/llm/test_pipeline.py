import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_secret_scan import base
from tests.llm.test_simhash import groups, plain_fingerprint
from webmart.llm import mixing, secret_scan, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_stages_equal_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash near-dedup", "secret scans", "mixing", "sentencepiece"]

    def stage(name, frame):
        out = stages[name](spark, frame, sf_dir)
        out = spark.createDataFrame(out.collect(), out.schema)
        assert name == "sentencepiece" or out.columns == COLUMNS
        return out

    clean = stage("toxicity", docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = toxicity.Scorer(toxicity.learn(docs, labels)).scores
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect() if score([r.text])[0] < 0.3}
    known = {r.doc_id for r in clean.collect()}
    kept = [r.doc_id in known for r in labels.where("toxic = 0").collect()]
    assert sum(kept) / len(kept) > 0.95

    single = stage("simhash near-dedup", clean)
    root = groups([plain_fingerprint(r.text) for r in clean.collect()])
    least = {}
    for row in clean.collect():
        key = root[plain_fingerprint(row.text)]
        least[key] = min(least.get(key, row.doc_id), row.doc_id)
    assert {r.doc_id for r in single.collect()} == set(least.values())

    redacted = stage("secret scans", single)
    assert redacted.count() == single.count()
    texts = {r.doc_id: r.text for r in single.collect()}
    for row in redacted.collect():
        assert row.text == secret_scan.redact(texts[row.doc_id], secret_scan.find_spans(texts[row.doc_id]))
        assert (row.text == texts[row.doc_id]) == (not base(texts[row.doc_id]))

    mixed = stage("mixing", redacted)
    rates = mixing.mixture(redacted).where("sampled")
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in rates.collect()}

    encoded = stage("sentencepiece", mixed)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert encoded.count() == len(texts)
    for row in encoded.collect():
        ids = LIBRARY.encode(texts[row.doc_id], add_eos=True)
        assert row.ids == ids and row.decoded == LIBRARY.decode(ids) and row.n_tokens == len(ids)

    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(whole.select("doc_id", "ids").collect()) == sorted(encoded.select("doc_id", "ids").collect())


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_stages_take_odd_rows(request, spark, sf_dir, name):
    docs = request.getfixturevalue(name)
    columns = docs.columns
    for stage, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, sf_dir)
        assert docs.columns == columns, stage
    corpus_pipeline.encode(spark, docs, sf_dir).select(F.count("*")).collect()
