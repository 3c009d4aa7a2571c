"""Each stage of the pipeline against what it says, and the whole."""

import hashlib

from llm_fixtures import make, no_docs, pairs  # noqa: F401
from test_llm_minhash import brute
from test_llm_repeats import removed_words
from test_llm_search import planted

import corpus_pipeline as P
from cohort_effects.llm.op4_quality import classify
from cohort_effects.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    columns = docs.columns
    stay = {r.doc_id for r in classify(docs, labels).collect() if r.predicted}
    kept = []
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(docs.collect())
        assert name == "packing" or docs.columns == columns
    quality, near, cut, clean, packed = kept
    assert {r.doc_id for r in quality} == stay
    assert {r.doc_id for r in near} == {i for i, _, c in brute([(r.doc_id, r.text) for r in quality], 5) if i == c}
    want = removed_words([(r.doc_id, r.text) for r in near])
    text = {r.doc_id: r.text for r in near}
    assert {r.doc_id for r in cut} == set(text)
    for r in cut:
        n_words, removed, sha = want[r.doc_id, text[r.doc_id]]
        assert r.text == text[r.doc_id] if not removed else hashlib.sha256(r.text.encode()).hexdigest() == sha
        assert r.n_chars == len(r.text)
    flat = lambda t: " ".join(t.split()).lower()
    leaked = {r.doc_id for r in cut if any(flat(b.text) in flat(r.text) for b in bench)}
    assert {r.doc_id for r in cut} - {r.doc_id for r in clean} == leaked
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}
    again = P.run(spark, SF)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in again.collect()} == {(r.doc_id, r.piece, r.ids_crc32) for r in packed}


def test_odd_rows_and_no_rows(spark, tmp_path, pairs, no_docs):
    _, bench, _, _ = planted(spark)
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(63, 0, 0), (1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs, some in ((make(spark, pairs), True), (no_docs, False)):
        columns = docs.columns
        for k, (name, stage) in enumerate(P.STAGES):
            path = f"{tmp_path}/{some}-{name}"
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            assert k == 4 or docs.columns == columns
        assert (docs.count() > 0) == some


def test_registered():
    numbers = [q for q in QUERIES if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in numbers) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
