"""Operators 11 to 13 against plain versions."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from terrapix.llm import op11_whitening as op11
from terrapix.llm import op12_quality_cnn as op12
from terrapix.llm import op13_runs as op13
from terrapix.llm.queries import QUERIES, plant_period
from tests.conftest import SF_SMALL
from tests.llm.fixtures import SCHEMA, awkward, frame, words

VECTORS = "vec_id long, embedding array<float>, label int, n long, component int"


def plain_whitening(rows, components=16):
    """numpy's eigenvectors of the distinct vectors' covariance."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    u = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, s = len(u), u.sum(axis=0)
    c = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(r, s)] for r in u])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = {i: sum((n * a - b) ** 2 for a, b in zip(r, s)) for (i, _), r in zip(rows, x)}
    white = {i: np.array([float(Fraction(int(n * a - b), n)) for a, b in zip(r, s)]) @ vectors / np.sqrt(values) for (i, _), r in zip(rows, x)}
    return n, values, values / np.trace(c.T @ c / n), deviation, white


def check_whitening(out, rows):
    n, values, explained, deviation, white = plain_whitening(rows)
    got = {}
    for r in out:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(got) == sorted(i for i, _ in rows)
    signs = None
    for i, comps in got.items():
        assert sorted(comps) == list(range(1, len(values) + 1))
        assert {c["n"] for c in comps.values()} == {n} and {c["deviation"] for c in comps.values()} == {deviation[i]}
        w = np.array([comps[k]["whitened"] for k in sorted(comps)])
        assert np.allclose([comps[k]["explained"] for k in sorted(comps)], explained, rtol=1e-10)
        signs = np.sign(w * white[i]) if signs is None else signs
        assert np.allclose(w * signs, white[i], atol=1e-8)
    assert all(abs(r["identity_error"]) <= 1e-10 for r in out)


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op11_whitening_chebyshev"](spark, SF_SMALL).collect(), rows)


def test_whitening_cases(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(0, 1 + np.arange(24) % 5, 24).astype(np.float32).tolist()) for i in range(80)]
    good += [(100 + i, good[3][1]) for i in range(60)]  # a hot vector
    bad = [(900, None), (901, []), (902, [1.0, None] * 12), (903, [float("nan")] * 24), (904, [float("inf")] * 24), (905, [1.0, 2.0]), (None, None)]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in good + bad], VECTORS).repartition(5)
    check_whitening(op11.whiten(df).collect(), good)
    same = spark.createDataFrame([(i, [0.5, 0.25], 1, 2, 3) for i in range(4)], VECTORS)
    assert op11.whiten(same).collect() == [] and op11.whiten(df.limit(0)).collect() == []
    flat = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]  # one direction only
    out = op11.whiten(spark.createDataFrame([(i, v, 1, 2, 3) for i, v in flat], VECTORS)).collect()
    assert {r["component"] for r in out} == {1} and len(out) == 9
    huge = spark.createDataFrame([(i, [1e300 * (-1) ** i, float(i)], 1, 2, 3) for i in range(5)], VECTORS.replace("float", "double"))
    assert {r["deviation"] for r in op11.whiten(huge).collect()} == {None}
    lost = spark.createDataFrame([(None, [1.0, 2.0], 1, 2, 3), (None, [1.0, 2.0], 1, 2, 3), (1, [2.0, 5.0], 1, 2, 3)], VECTORS)
    assert [r["vec_id"] for r in op11.whiten(lost).collect()].count(None) == 2


def test_whitening_is_certified_and_groups_add_up(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in enumerate(rng.normal(0, 1, (400, 70)).tolist())], VECTORS)
    model = op11.fit(op11.scaled(df))
    assert model.residual <= op11.TOLERANCE and len(model.residuals) > 3 and model.identity_error < 1e-10
    monkeypatch.setattr(op11, "PARTS", 2)
    again = op11.fit(op11.scaled(df.repartition(9)))
    assert np.allclose(again.values, model.values, rtol=1e-12)


def plain_runs(ws):
    found = {}
    for q in range(1, len(ws) // 4 + 1):
        i = 0
        while i + q < len(ws):
            j = i
            while j + q < len(ws) and ws[j] == ws[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found[(i, j + q - i)] = min(q, found.get((i, j + q - i), q))
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_summary(text):
    ws = text.encode().split()
    runs = plain_runs(ws)
    keep = [not any(s + q <= k < s + n for s, n, q in runs) for k in range(len(ws))]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    one = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(runs), *one, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(w for w, k in zip(ws, keep) if k)))


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(400):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            d = [rng.randrange(rng.choice([1, 2, 3, 12])) for _ in range(rng.randrange(rng.choice([9, 40, 150])))]
            if d and rng.random() < 0.6:
                a, p = rng.randrange(len(d)), rng.randrange(1, 1 + max(1, len(d) // 4))
                d = [d[a + (i - a) % p] if i >= a + p else x for i, x in enumerate(d)]
                if rng.random() < 0.4:
                    d[rng.randrange(len(d))] = 77
            docs.append(d)
        first = np.cumsum([0] + [len(d) for d in docs])
        got = list(zip(*[a.tolist() for a in op13.runs_of(np.array([x for d in docs for x in d], np.uint64), first)]))
        assert got == [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d)]


def test_extensions():
    rng = np.random.default_rng(5)
    for kinds in (1, 2, 3, 50):
        w = rng.integers(1, kinds + 1, 300).astype(np.uint64)
        w[150:260] = w[20:130]
        i = rng.integers(0, 299, 500)
        j = np.minimum(i + rng.integers(1, 200, 500), 299)
        i, j = i[i < j], j[i < j]
        want = []
        for a, b in zip(i, j):
            k = 0
            while b + k < 300 and w[a + k] == w[b + k]:
                k += 1
            want.append(k)
        assert op13.Extensions(w).right(i, j).tolist() == want


def test_runs_cases(spark):
    rows = awkward() + [(500, "go " * 40, "en", "s", 1, 7, 8, 9, "x", "y", 0.5, 1, 3), (501, "a b c d " * 9 + "a b", "en", "s", 1, 7, 8, 9, "x", "y", 0.5, 1, 3)]
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in op13.summary(df).select("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect() if r)
    assert sorted(map(repr, got)) == sorted(repr(plain_summary(t or "")) for _, t, *_ in rows)
    long = [(r["doc_id"], r["start"], r["length"], r["period"]) for r in op13.find_runs(df).collect()]
    assert sorted(map(repr, long)) == sorted(repr((d, *r)) for d, t, *_ in rows for r in plain_runs((t or "").encode().split()))
    cut = {r["doc_id"]: r for r in op13.collapse(df.filter("doc_id >= 500")).collect()}
    assert cut[500]["text"] == "go" and cut[501]["text"] == "a b c d" and cut[500].asDict().keys() == rows_columns()
    assert op13.summary(df.limit(0)).collect() == [] and op13.collapse(df.limit(0)).collect() == []


def rows_columns():
    return {c.split()[0]: None for c in SCHEMA.split(", ")}.keys()


def test_runs_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    planted = 0
    for r in QUERIES["op13_runs_difference_cover"](spark, SF_SMALL).collect():
        t = (texts[r["doc_id"]] or "").encode().split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and t:
            planted += 1
            a = h // 10 % len(t)
            p = 1 + (len(t) - a) // (3 + h // 10 % 8)
            t = [w if i < a else t[a + (i - a) % p] for i, w in enumerate(t)]
        if len(t) <= 1500:  # the plain version is quadratic
            assert tuple(r)[1:] == plain_summary(b" ".join(t).decode())
    assert planted > 5 and plant_period(None, b"a b") == b"a b" and plant_period(1, b"") == b""


def test_runs_of_very_long_texts_are_found_in_time():
    import time
    n = 200_000
    for w, runs in ((np.ones(n, np.uint64), [(0, 0, n, 1)]), (np.tile(np.arange(7_000, dtype=np.uint64), 29)[:n], [(0, 0, n, 7_000)])):
        t = time.time()
        assert list(zip(*[a.tolist() for a in op13.runs_of(w, np.array([0, n]))])) == runs
        assert time.time() - t < 30


def test_network_gradients():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 3, 700, 1500, op12._HALF - 5, op12._HALF, 513)]
    off, buf = np.concatenate([[0], np.cumsum([len(t) for t in texts])]), np.frombuffer(b"".join(texts), np.uint8)
    p = {k: v.astype(np.float64) for k, v in op12.initial().items()}
    y, share = np.array([0, 1, 0, 1, 1, 0, 1.0]), np.full(7, 1 / 7)
    _, g = op12.gradients(buf, off, y, share, p)
    for k in op12.SHAPES:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        losses = []
        for step in (1e-4, -2e-4):
            p[k][at] += step
            losses.append(op12.gradients(buf, off, y, share, p)[0])
        p[k][at] += 1e-4
        assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(g[k][at], rel=1e-3)


def test_network_sees_every_byte_and_no_other_row():
    p = op12.initial()
    model = op12.Model(p)
    texts = [words(n, n).encode() for n in (3, 40, 400, 5000)] + [b"", b"x"]

    def scored(ts):
        off = np.concatenate([[0], np.cumsum([len(t) for t in ts])])
        return model.log_odds(np.frombuffer(b"".join(ts), np.uint8), off)
    together = scored(texts)
    assert np.allclose(together, [scored([t])[0] for t in texts], atol=1e-5)
    # the plain network, window by window
    for t, got in zip(texts, together):
        data = np.frombuffer(t, np.uint8)
        n = max(1, -(-(len(data) + op12.WIDTH - 1) // op12._HALF)) * op12._HALF
        padded = np.concatenate([np.zeros(op12.WIDTH - 1, np.uint8), data, np.zeros(n - len(data), np.uint8)])
        z = np.stack([np.einsum("we,wef->f", p["embed"][padded[i:i + op12.WIDTH]], p["filters"]) for i in range(n)])
        total = weights = 0.0
        for a in range(0, max(n - op12._HALF, 1), op12._HALF):
            top = np.maximum(z[a:a + op12.CHUNK].max(axis=0) + p["filter_bias"], 0)
            odds = np.maximum(top @ p["hidden"] + p["hidden_bias"], 0) @ p["out"] + p["out_bias"][0]
            weight = sum(min(max(len(data) + op12.WIDTH - 1 - h, 1), op12._HALF) for h in range(a, min(a + op12.CHUNK, n), op12._HALF))
            total, weights = total + odds * weight, weights + weight
        assert got == pytest.approx(total / weights, abs=1e-3)


def test_network_learns_and_keeps_held_out_rows_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = {r["doc_id"]: r for r in op12.score(docs, op12.fit(docs, labels)).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for i, r in out.items())
    held = [i for i in truth if out[i]["held_out"]]
    good, bad = [out[i]["score"] for i in held if truth[i] == 1], [out[i]["score"] for i in held if truth[i] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.85
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    as_given, as_turned = (sorted(tuple(r) for r in op12._training_rows(docs, x, "quality").collect()) for x in (labels, turned))
    assert as_given == as_turned and len(as_given) > 100


def test_network_cases(spark):
    df = frame(spark)
    labels = spark.createDataFrame([(d, int(d % 2), int(d % 3 == 0), "x") for d in [*range(18), *range(100, 112), 3]] + [(None, 1, 1, "x"), (5, None, 1, "x")], "doc_id long, quality int, toxic int, text string")
    out = op12.score(df, op12.fit(df, labels)).collect()
    assert len(out) == len(awkward()) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 7}) == 1
    assert {r["score"] for r in op12.score(df, op12.fit(df, labels.limit(0))).collect()} == {0.5}
    assert op12.score(df.limit(0), op12.fit(df.limit(0), labels)).collect() == []
    assert {r["held_out"] for r in out if r["doc_id"] is None} == {False}


def test_words_cut_at_line_breaks_and_end_marks_as_the_library():
    import random

    import numpy as np
    import pyarrow as pa
    import public_tokenizers

    from terrapix.llm import op1_token_file
    from terrapix.llm import textvec as tv

    table = op1_token_file.WordTable(public_tokenizers.path("byte_bpe_50k.json"))
    assert table.words.splits
    draw = random.Random(3)
    parts = ["a", "Z", "é", "ß", "×", "÷", "À", "ÿ", "\n", "\n\n", " ", ".", ",", "'", "'s", "!!", "%%%", "9", "١", "…", "　", "\t", "\r",
             "日", "\U0001F642", "&", "'ll", " don't", "Ĳ", "!" * 12, "\x7f", "\x00", "\xa0", "\x85"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(20_000)]
    for i, j, buf, off in tv.chunks(pa.array(texts)):
        for text, ids in zip(texts[i:j], table.rows(buf, off)):
            assert np.frombuffer(ids, "<u4").tolist() == table.words.tok.encode(text, add_special_tokens=False).ids, text


def test_secret_values_in_linear_time():
    import time

    from terrapix.llm import op10_secrets

    for unit in (b"a:", b'="', b"='x", b"token=a&", b"a:;"):
        began = time.monotonic()
        assert op10_secrets._values(unit * (300_000 // len(unit)))
        assert time.monotonic() - began < 8, unit


@pytest.mark.parametrize("k", [1, 7, 100, 5000])
def test_smallest_rows(spark, k):
    from terrapix.llm.smallest import smallest

    draw = random.Random(k)
    rows = [(draw.choice([-5, 3, 3, 3, 1 << 60, draw.randrange(-1000, 1000)]), draw.randrange(1 << 40), i) for i in range(4000)] + [(None, 1, -1)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(5).checkpoint()
    got = [tuple(r) for r in smallest(df, ["a", "b"], k).collect()]
    want = sorted(r for r in rows if r[0] is not None)[:k]
    assert sorted(got)[:k] == want and len(got) <= max(2 * k, len(want))
    assert smallest(df.limit(0), ["a", "b"], k).count() == 0
