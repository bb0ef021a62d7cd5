import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tableflow.llm import pii
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "best-fit packing"
    ]
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        out.append(docs.collect())
        assert i == 4 or docs.columns == columns
    whole = {d["doc_id"]: d for d in brute.rows(SF, "documents")}
    good, single, clean, masked, packed = out
    # Quality rules: what fails the base rule is gone, rows that stay are as they were, and labelled good ones stay.
    assert all(r.asDict() == whole[r.doc_id] for r in good)
    assert not any(brute.rules(r.text)[5] for r in good)
    kept = {r.doc_id for r in good}
    fine = [r["doc_id"] for r in brute.rows(SF, "labels") if r["quality"] and not brute.rules(whole[r["doc_id"]]["text"])[5]]
    assert sum(i in kept for i in fine) > 0.99 * len(fine)
    # Near copies: the least id of each component.
    want = {c for _, _, c in brute.jaccard_components([(r.doc_id, r.text) for r in good])}
    assert sorted(r.doc_id for r in single) == sorted(want)
    # Benchmark: what is not contaminated.
    rows = brute.contamination([r.asDict() for r in single], brute.rows(SF, "benchmark"))
    assert sorted(r.doc_id for r in clean) == sorted(r[0] for r in rows if not r[-1]) and any(r[-1] for r in rows)
    # PII: every base match is masked, and texts without any keep all but revealing terms.
    before = {r.doc_id: r.text for r in clean}
    assert sorted(before) == sorted(r.doc_id for r in masked)
    for r in masked:
        found = brute.matches(before[r.doc_id], brute.PERSONAL)
        assert bool(found) == any(m and m in r.text for m in pii.MASKS[:4]) or before[r.doc_id] == r.text
        assert not any(before[r.doc_id][s:e] in r.text for _, s, e in found if e - s > 9)
        assert r.n_chars == len(r.text)
    # Packing: all ids of all texts.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ps = brute.pieces([r.text for r in masked], tokenizer)
    assert sorted((r.doc_id, *p) for r, q in zip(masked, ps, strict=True) for p in q) == sorted(tuple(r[:5]) for r in packed)


def test_pipeline_of_odd_tables(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long, doc string, uid int"
    rows = [(1, None), (2, ""), (None, "a b"), (3, "word " * 60), (3, "word " * 60), (4, "one two three " * 30 + "x y z joe@x.org")]
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for n, part in enumerate((rows, [])):
        docs = spark.createDataFrame([(i, t, None, "s", 1, "c", 1) for i, t in part], kind)
        for _, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{n}{stage.__name__}")
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
