"""The corpus pipeline against its stages done by hand, and the registration of the queries."""

import os
import random

import __spark_entry__ as entry
import corpus_pipeline
from subledger.llm import decontam, pii, rules
from subledger.llm.common import table
from tests.llm.test_corpus_operators import SF, plain_components, plain_fingerprint


def test_stages_and_run(spark):
    docs = table(spark, SF, "documents")
    by_hand = {r.doc_id: r for r in rules.quality_digest(docs).collect() if r.kept}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in by_hand}
    parts = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if parts[i] == i}
    leaked = {r.doc_id for r in decontam.leaks(spark, docs, table(spark, SF, "benchmark")).collect()}
    texts = {i: t for i, t in texts.items() if i not in leaked}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns, name
    got = {r.doc_id: r.text for r in kept.collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert not pii.base_spans(got[i])
        if not pii.base_spans(t):
            assert got[i] == t
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == set(texts)


def test_stages_on_odd_rows(spark, scratch):
    """Null, empty and very long texts, null and repeated ids, repeated rows, clashing columns; then the whole run; then nothing."""
    word = lambda i: "".join(chr(97 + (i * 7 + k * k) % 26) for k in range(3 + i % 5)) + str(i % 97)
    clean = [" ".join(word(j * 31 + i * 17) for i in range(60)) for j in range(4)]
    rng = random.Random(1)
    long = " ".join(word(rng.randrange(5000)) + chr(97 + rng.randrange(26)) for _ in range(30_000))
    rows = [(1, clean[0]), (2, clean[1]), (2, clean[2]), (3, clean[0]), (3, clean[0]), (None, clean[3]), (4, None), (5, ""), (6, long), (7, "\n ")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` int, kept string, `__key` int, component string"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", 2, "y") for i, t in rows], schema)
    docs.write.parquet(os.path.join(scratch, "documents.parquet"))
    table(spark, SF, "benchmark").write.parquet(os.path.join(scratch, "benchmark.parquet"))
    want = {"quality_rules": 7, "simhash_near_dedup": None, "benchmark_decontamination": 10, "personal_data": 10}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, scratch)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        got = out.collect()
        if want[name] is not None:
            assert len(got) == want[name], name
        else:    # one of each group of texts; texts without words are one group, and a null id is a document of its own
            assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted(
                [(1, clean[0]), (2, clean[1]), (2, clean[2]), (0, clean[3]), (4, ""), (6, long)])
        assert stage(spark, docs.limit(0), scratch).count() == 0, name
    assert corpus_pipeline.best_fit_packing(spark, docs.limit(0), scratch).count() == 0
    packed = corpus_pipeline.run(spark, scratch).collect()
    assert sorted({r.doc_id or 0 for r in packed}) == [0, 1, 2, 6]


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert os.path.exists(corpus_pipeline.__file__)
