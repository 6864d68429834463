import os

from helpers import ODD, frame

import corpus_pipeline
from cantora.llm import stages

SF = "/root/testdata/sf0.001"


def stage(spark, name, docs, sf_dir=SF):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)


def test_stage_order_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "pack"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        assert out.count() <= docs.count()


def test_run_equals_the_stages_by_hand(spark):
    from helpers import shingles
    from test_decontaminate import brute as leaks
    from test_minhash import brute as near
    from test_packing import JSON
    from test_pii import brute as spans
    from test_quality import brute as good
    from tokenizers import Tokenizer

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if good(r[1])[6]]
    groups = near(rows, stages.NEAR_PERCENT)
    rows = [r for r in rows if groups[r[0]] == r[0]]
    grams = {g for _, t in items for g in shingles(t)}
    hit = [r for r in rows if shingles(r[1]) & grams]       # others share no seed
    leaked = {i for i, *_ in leaks(hit, items)}
    rows = [r for r in rows if r[0] not in leaked]
    t, want = Tokenizer.from_file(JSON), {}
    for i, text in rows:
        if not spans(text):
            want[i] = len(t.encode(text, add_special_tokens=False).ids) + 1
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert set(got) == {i for i, _ in rows}
    assert all(got[i] == n for i, n in want.items())


def test_odd_rows_and_empty_tables_pass_every_stage(spark, tmp_path):
    for name, f in corpus_pipeline.STAGES:
        for rows in (ODD, []):
            out = f(spark, frame(spark, rows), SF)
            assert len(out.collect()) <= max(len(rows), 0) or name == "pack"
    assert os.path.isdir(SF)


def test_near_copies_from_four_fifths_on_go(spark):
    import random

    from test_minhash import brute

    rng, rows = random.Random(6), []
    for edits in (4, 4, 4, 4, 6):   # similarity 176/216 = 0.815, and 166/226 = 0.73
        w = [f"p{rng.randrange(10**9)}" for _ in range(200)]
        v = list(w)
        for k in range(edits):
            v[20 + 30 * k] = f"q{rng.randrange(10**9)}"
        rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(v))]
    got = {r.doc_id for r in stage(spark, "near_dedup", frame(spark, rows)).collect()}
    groups = brute(rows, 80)
    assert got == {i for i, _ in rows if groups[i] == i} == {0, 2, 4, 6, 8, 9}
