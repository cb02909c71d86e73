"""Registered queries: SQL twins, whole tables, and the pipeline by stages."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from terrapix.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL, duck
from tests.llm.test_operators import FOLD, brute_components, brute_hits, brute_lines, brute_stats, shingle_set
from tools.oracle_check import digest


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck(SF_SMALL).sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, rows) == digest(rel.columns, rel.fetchall())


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.startswith(("op1_", "op3_", "op4_", "op7_", "op8_", "op9_", "op12_", "op13_"))])
def test_a_row_for_every_document(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_pipeline_by_stages(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    frames = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(tmp_dir, f"{i}-{name}")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        frames.append((docs, spark.read.parquet(path)))
        docs = frames[-1][1]
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns

    def pairs(df):
        return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]
    # 1: nothing that fails the base rule stays
    before, after = (pairs(x) for x in frames[0])
    kept = {d for d, _ in after}
    for d, t in before:
        s = brute_stats(t)
        if s[0] < 50 or 100 * s[4] > 50 * s[0]:
            assert d not in kept
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("quality = 1").collect()}
    passing = {d for d, t in before if d in good and not ((s := brute_stats(t))[0] < 50 or 100 * s[4] > 50 * s[0])}
    assert len(passing & kept) >= 0.9 * len(passing)
    # 2: lines
    before, after = (pairs(x) for x in frames[1])
    want = [(d, t) for d, _, lost, t in brute_lines(before, corpus_pipeline.LINE_DOCUMENTS, corpus_pipeline.LINE_CHARS, keep_first=True) if not (lost and not t.strip(" \t\n\x0b\x0c\r"))]
    assert sorted(after) == sorted(want)
    # 3: one of each group
    before, after = (pairs(x) for x in frames[2])
    want = {c for d, n, c in brute_components(before) if n} | {d for d, t in before if not shingle_set(t)}
    assert {d for d, _ in after} == want and dict(after).items() <= dict(before).items()
    # 4: no benchmark window is left
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    before, after = (pairs(x) for x in frames[3])
    hits = {d: (n, h) for d, n, h, _ in brute_hits(before, items, 10)}
    assert {d for d, _ in after} == {d for d, (n, h) in hits.items() if h <= corpus_pipeline.MAX_COVERAGE * n}
    untouched = {d for d, (_, h) in hits.items() if not h}
    assert all(dict(before)[d] == t for d, t in after if d in untouched)
    # 5: ids as the library gives them
    import numpy as np
    import sentencepiece
    from terrapix.llm.queries import tokenizer_path
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = dict(pairs(frames[4][0]))
    for r in frames[4][1].collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == sp.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(ids)
    assert FOLD  # shared with the operators' tests
