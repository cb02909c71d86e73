"""Cases of the second review: each fails on the code before it."""

import itertools
from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from terrapix.llm import op5_line_dedup as op5, op8_token_counts as op8, op10_secrets as op10
from terrapix.llm.queries import tokenizer_path
from tests.llm.fixtures import words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- pipeline

def test_copies_with_short_lines_leave_one_document(spark, tmp_dir):
    """A group of 12 copies whose short lines are as frequent as the long ones."""
    text = "\n".join(["Menu", words(40, 1), "All rights reserved.", words(40, 2), "Share", "home | about us"])
    docs = [(i, text) for i in range(3, 15)] + [(100 + i, words(60, 200 + i)) for i in range(5)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], COLUMNS).repartition(3)
    corpus_pipeline.line_dedup(spark, df, "").write.parquet(f"{tmp_dir}/lines")
    out = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_dir}/lines"), "")
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(3, text), *docs[12:]]


# ---- 5

@pytest.mark.parametrize("broadcast", [400_000, 0])
def test_one_copy_stays_when_no_row_has_an_id(spark, monkeypatch, broadcast):
    monkeypatch.setattr(op5, "BROADCAST_KEYS", broadcast)
    text = "a line of ten rows\nand another"
    docs = [(None, text)] * 12 + [(None, "held by an id\nalone")] * 3 + [(9, "held by an id"), (4, "Held by an id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out, (lines, dropped) = op5.dedup_lines(df, at_least=3, keep_first=True)
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert got == {(None, text): 1, (None, ""): 13, (None, "alone"): 1, (4, "Held by an id"): 1, (9, ""): 1}
    assert out.agg({dropped: "sum"}).first()[0] == 22 + 2 + 4


# ---- 8

def test_texts_with_the_word_start_mark_are_encoded_whole(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    texts = ["the▁ ▁the", "caf▁ 12", "▁", "a ▁ b", "plain words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in op8.token_counts(df, path).collect()}
    sp = op8.PieceCounter(path).sp
    assert got == {i: len(sp.encode(t)) for i, t in enumerate(texts)}
    assert [got[0], got[1]] == [3, 4]


# ---- 10

def test_dictionary_counts_every_word(spark, monkeypatch):
    """More words than a task once reported, in frequencies that differ by task."""
    names = ["".join(p) for p in itertools.product("abcdefghijklmnopqrst", repeat=3)][:6000]
    texts = [" ".join(names[i % 7::1 + i % 5] + names[:50 * i]) for i in range(40)]
    count = Counter(w for t in texts for w in t.split())
    want = sorted(count, key=lambda w: (-count[w], w))
    assert len(want) > 4096
    for parts in (1, 4):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).repartition(parts)
        assert op10.dictionary(df) == want[:op10.DICTIONARY]
    monkeypatch.setattr(op10, "TRACKED", 100)
    got = Counter()
    for b in op10._summaries([pa.RecordBatch.from_arrays([pa.array([*texts, None, ""])], ["text"])]):
        for r in b.to_pylist():
            got[r["word"]] += r["n"]
    assert got == count


SHORT = [('password=hunter2secret now', "hunter2secret"), ("secret: Tr0ub4dor!3xyz", "Tr0ub4dor!3xyz"), ('{"pwd":"a$b"}', "a$b"), ("token = 'x y%z' end", "x y%z"),
         ("http://h/?u=me&password=p:w!1&x=2", "p:w!1"), ("password hunter2!", "hunter2!"), ("é DB_PASSWORD: pässwört,", "pässwört"), ("key: k.", "k"), ("say \"set password: Tr0!b4 now\"", "Tr0!b4"),
         ("see token=abcdef0123456789abcd!tail", "abcdef0123456789abcd"), ("auth=ab12==", "ab12==")]


def test_values_after_a_context_are_candidates_at_any_length(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SHORT)], "doc_id long, text string")
    rows = op10.candidates(df, []).collect()
    got = {(r["doc_id"], r["start"], r["end"], r["value"]) for r in rows}
    assert len(got) == len(rows)
    for i, (t, v) in enumerate(SHORT):
        at = len(t[:t.rindex(v)].encode())
        assert (i, at, at + len(v.encode()), v) in got, t
        assert all(t.encode()[a:z].decode() == x for d, a, z, x in got if d == i)


def test_runs_without_context_keep_the_length_rule():
    assert not op10._values(b"no context here hunter2secret, abcdefghij0123456789")


def test_values_grow_with_the_text():
    for unit in (b"a=", b"token=", b"k=v&", b"a:b,", b"password=x;"):
        spans = op10._values(unit * 2000)
        assert sum(z - a for a, z in spans) < 20 * len(unit) * 2000, unit


def test_findings_label_short_values(spark):
    """Labels that name short credentials reach the forest, which finds others like them."""
    docs = [(i, f"{words(8, i)} " + (f"password=hun{i}!s" if i % 2 else f"note: {words(1, i)}") + f" {words(8, i + 500)}") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    spans = {i: (t.encode().index(b"hun"), t.encode().index(b"!s") + 2) for i, t in docs if i % 2}
    found = op10.candidates(df, op10.dictionary(df)).select("doc_id", "start", "end").collect()
    labels = [(d, a, z, int(spans.get(d) == (a, z))) for d, a, z in found if d < 150]
    got = {(r["doc_id"], r["start"], r["end"]) for r in op10.scan(df, spark.createDataFrame(labels, "doc_id long, start long, end long, label int")).collect()}
    assert got == {(d, *s) for d, s in spans.items()}
