"""Each operator against a brute-force version, on awkward small frames."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from terrapix.llm import (op1_token_file as op1, op2_jaccard_join as op2, op3_toxicity as op3, op4_sentencepiece as op4, op5_line_dedup as op5,
                          op6_decontaminate as op6, op7_quality as op7, op8_token_counts as op8, op9_sharding as op9, op10_secrets as op10)
from terrapix.llm.queries import tokenizer_path
from tests.llm.fixtures import SCHEMA, awkward, frame, words

WS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pairs():
    return [(r[0], r[1]) for r in awkward()]


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ---- 1

@pytest.mark.parametrize("ids", [[], [5], [2**32 - 1, 7, 7, 2**32 - 1], [1] * 5000, list(range(70000)), np.random.default_rng(1).integers(0, 50257, 9000).tolist()])
def test_op1_block_round_trip(ids):
    block = op1.pack(np.array(ids, np.uint32))
    assert op1.unpack(block).tolist() == ids


def test_op1_repeated_ids_compress_and_damage_is_found():
    ids = np.tile(np.random.default_rng(2).integers(0, 50000, 400), 500).astype(np.uint32)
    block = op1.pack(ids)
    assert len(block) < len(ids)  # under 8 of 32 bits for ids seen before
    for at in (0, 30, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            op1.unpack(bytes(bad))


def test_op1_files(spark, tmp_dir):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    op1.write_tokens(frame(spark), f"{tmp_dir}/tokens", path, end_id=2)
    got = op1.read_tokens(spark, f"{tmp_dir}/tokens", with_ids=True).orderBy("start").collect()
    want = Counter((d, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 2])) for d, t in pairs())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    before = 0
    for r in got:
        assert r["start"] == before and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        before += r["n_tokens"]
    empty = spark.createDataFrame([], SCHEMA)
    assert op1.token_table(empty, path).count() == 0


def test_op1_word_cache_equals_library(monkeypatch):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = [t or "" for _, t in pairs()] + ["don't 'll I've it's 's x's", "a. b, c.d, .e, ,", "Zoë's ª µ ǅ ʰ 12½ ²", "é, é. ß, x1, a,. b", "one, one. one one", " led by, a space", "ends in a space ", "word,", ","]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for held in (4, 40, op1.CACHED):  # the table turns over
        monkeypatch.setattr(op1, "CACHED", held)
        table = op1.WordTable(path)
        assert table.words.splits
        for _ in range(3):
            assert [np.frombuffer(x, "<u4").tolist() for x in table.rows(buf, off)] == want


# ---- 2

def shingle_set(text):
    w = WS.findall((text or "").translate(FOLD))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_components(docs):
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        least[find(i)].append(d)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(docs)), key=str)


def test_op2_awkward(spark):
    got = rows_of(op2.near_duplicates(frame(spark)), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(pairs())
    assert op2.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("crowded, query_bytes, rounds", [(64, 32 << 20, 3), (2, 2000, 1)])
def test_op2_chains_and_thresholds(spark, monkeypatch, crowded, query_bytes, rounds):
    """Chains of edits (links only between neighbours), unrelated documents
    sharing passages, and pairs just on either side of the threshold."""
    for name, value in (("CROWDED", crowded), ("QUERY_BYTES", query_bytes), ("ROUNDS", rounds)):
        monkeypatch.setattr(op2, name, value)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, n = [], 0
    passage = words(60, 99, vocabulary)
    for group in range(6):
        text = words(100 + 10 * group, group, vocabulary).split(" ")
        for step in range(9):
            docs.append((n, " ".join(text)))
            n += 1
            for k in range(1 + group % 3):
                text[(step * 11 + 7 * k + group) % len(text)] = f"e{n}x{k}"
    for i in range(25):
        docs.append((n, words(10 + i, 500 + i, vocabulary) + " " + passage))
        n += 1
    df = spark.createDataFrame([(d, t) for d, t in docs], "doc_id long, text string").repartition(4)
    assert rows_of(op2.near_duplicates(df), "doc_id", "n_shingles", "component_id") == brute_components(docs)


def test_op2_prefix_never_loses_a_similar_pair():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = a.copy()
        k = int(rng.integers(0, max(1, len(a) // 6)))
        if k:
            b[rng.choice(len(b), k, replace=False)] = rng.integers(0, 2**63, k, dtype=np.uint64)
            b = np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        often = rng.choice(a, max(1, len(a) // 3), replace=False)
        order = op2.Order(np.sort(often), rng.integers(2, 1000, len(often)))
        (pa_, la), (pb, lb) = order.prefix(a), order.prefix(b)
        assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_op2_keep_one(spark):
    df = frame(spark)
    kept = op2.keep_one(df)
    assert kept.columns == df.columns
    groups = brute_components(pairs())
    with_sets = {d: c for d, n, c in groups if n and d is not None}
    got = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None and shingle_set(r["text"])]
    assert sorted(got) == sorted(set(with_sets.values()))  # one row of each group
    without = [r for r in kept.collect() if not shingle_set(r["text"])]
    assert len(without) == sum(1 for _, t in pairs() if not shingle_set(t))


# ---- 3

def toxic_frame(spark, n=600):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        sentences = [words(8, 1000 * i + k).replace(".", "") for k in range(int(rng.integers(2, 8)))]
        if bad:
            sentences[int(rng.integers(len(sentences)))] += " " + str(rng.choice(["nastyword", "vileword", "nastywords"]))
        docs.append((i, ". ".join(sentences)))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_op3_learns_and_locates(spark):
    docs, labels = toxic_frame(spark)
    model = op3.fit(docs, labels)
    got = {r["doc_id"]: r for r in op3.score(docs, model).collect()}
    assert len(got) == 600
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], int(i % 4 == 0)) for i, r in got.items() if r["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    found = op3.locate(docs, model).collect()
    assert {r["doc_id"] for r in found} >= {i for i, r in got.items() if r["score"] > 0.9}
    assert all(re.search("nastyword|vileword", r["text"]) for r in found)


def test_op3_awkward(spark):
    _, labels = toxic_frame(spark, 40)
    df = frame(spark)
    scores = op3.score(df, op3.fit(df, labels.withColumnRenamed("quality", "score")))
    assert scores.count() == len(pairs()) and scores.filter("score is null or score < 0 or score > 1").count() == 0
    nothing = op3.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert op3.score(df, nothing).select("score").distinct().count() >= 1
    assert op3.score(spark.createDataFrame([], SCHEMA), nothing).count() == 0


# ---- 4

def test_op4_equals_library():
    import random

    import sentencepiece
    path = tokenizer_path("piece_bpe_32k.model")
    sp, fst = sentencepiece.SentencePieceProcessor(model_file=path), op4.transducer(path)
    rng = random.Random(4)
    texts = [t or "" for _, t in pairs()]
    for letters in ("ab ", "aeiou rst  ", "{}()[].,'\" \n", "0123456789.", "é日🙂a ▁", "the in on"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 50))) for _ in range(200)]
    for t, ids in zip(texts, fst.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == sp.encode(t), t
        assert fst.decode(ids) == sp.decode(sp.encode(t))


def test_op4_unigram_path_is_the_best(monkeypatch):
    """The same composition with unigram weights, against all segmentations."""
    fst = op4.Transducer(tokenizer_path("piece_bpe_32k.model"))
    monkeypatch.setattr(fst, "kind", op4.UNIGRAM)
    for word in ("▁thing", "▁reader", "▁a日b"):
        best = min((sum(fst.weight.get(p, op4._UNKNOWN) for p in s) for s in _splits(word) if all(p in fst.ids or len(p) == 1 for p in s)))
        assert sum(fst.weight.get(p, op4._UNKNOWN) for p in fst.path(word)) == best


def _splits(word):
    for cut in itertools.product([0, 1], repeat=len(word) - 1):
        out, last = [], 0
        for i, c in enumerate(cut, 1):
            if c:
                out.append(word[last:i])
                last = i
        yield [*out, word[last:]]


def test_op4_frames(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    df = frame(spark)
    out, names = op4.encode(df, path, with_decoded=True)
    assert out.columns == [*df.columns, *names] and names[0] == "ids_"  # the frame has a column ids
    assert all(r[names[1]] == (r["text"] or "") for r in out.collect())
    again = op4.decode(out.select("doc_id", names[0]), path, names[0])
    assert rows_of(again, "doc_id", "decoded") == rows_of(out.withColumnRenamed(names[1], "d"), "doc_id", "d")
    assert op4.encode(spark.createDataFrame([], SCHEMA), path)[0].count() == 0


# ---- 5

def brute_lines(docs, at_least, min_chars, keep_first=False):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    held, first = Counter(), {}
    for d, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k] += 1
            if d is not None:
                first[k] = min(first.get(k, d), d)
    bad = {k for k, n in held.items() if n >= at_least and len(k) >= min_chars}
    out = []
    for d, t in docs:
        lines, kept, spared = (t or "").split("\n"), [], set()
        for line in lines:
            k = key(line)
            if k in bad and not (keep_first and d is not None and first.get(k) == d and k not in spared):
                continue
            spared.add(k)
            kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("broadcast", [400_000, 0])
def test_op5_awkward(spark, monkeypatch, keep_first, broadcast):
    monkeypatch.setattr(op5, "BROADCAST_KEYS", broadcast)
    df = frame(spark)
    out, names = op5.dedup_lines(df, at_least=3, min_chars=1, keep_first=keep_first)
    assert out.columns == [*df.columns, *names] and names[0] == "n_lines_"
    assert rows_of(out, "doc_id", *names, "text") == brute_lines(pairs(), 3, 1, keep_first)


def test_op5_levels_and_settled_runs(spark):
    """More batches than a level holds: runs are compacted, settled keys are
    neither lost nor counted twice."""
    runs = op5.LineRuns(spark, 10)
    want = Counter()
    for batch in range(9):
        rows = [(k, k, 1 + (k + batch) % 4) for k in range(20) if (k + batch) % 3]
        for hi, _, n in rows:
            want[hi] += n
        runs.add(spark.createDataFrame(rows, "hi long, lo long, n long"))
    assert len(runs.levels) > 1 and runs.settled
    assert sorted(r["hi"] for r in runs.frequent().collect()) == sorted(k for k, n in want.items() if n >= 10)
    out, _ = op5.dedup_lines(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0


# ---- 6

W6 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items, window):
    wins = defaultdict(set)
    for name, t in items:
        w = W6.findall((t or "").translate(FOLD))
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            wins[tuple(w[i:i + window])].add(name)
    out = []
    for d, t in docs:
        w = W6.findall((t or "").translate(FOLD))
        hit, met = set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hit |= set(range(i, i + k))
                    met |= wins[tuple(w[i:i + k])]
        out.append((d, len(w), len(hit), sorted(x for x in met if x is not None)))
    return sorted(out, key=str)


ITEMS = [("a", words(25, 1)), ("b", words(25, 1)), ("c", "The end. OTHER"), ("d", "one"), ("e", None), ("f", "..."), (None, words(40, 2)), ("g", words(14, 5)), ("g", words(30, 3)), ("h", "the of the of the of the of the of the of the")]


@pytest.mark.parametrize("block", [1_000_000, 30])
def test_op6_awkward(spark, monkeypatch, block):
    monkeypatch.setattr(op6, "BLOCK_WORDS", block)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = rows_of(op6.scan(frame(spark), bench), "doc_id", "n_words", "n_hit", "items")
    assert got == brute_hits(pairs(), ITEMS, 10)
    assert op6.scan(spark.createDataFrame([], SCHEMA), bench).count() == 0
    clean = op6.scan(frame(spark), spark.createDataFrame([], "item_id string, text string"))
    assert clean.filter("n_hit > 0").count() == 0


def test_op6_random_words(spark):
    """A tiny vocabulary makes overlapping factors and clones."""
    vocabulary = ["x", "y", "z"]
    items = [(f"i{i}", words(2 + i * 3, i, vocabulary)) for i in range(8)]
    docs = [(i, words(60, 70 + i, vocabulary)) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows_of(op6.scan(df, spark.createDataFrame(items, "item_id string, text string"), window=6), "doc_id", "n_words", "n_hit", "items")
    assert got == brute_hits(docs, items, 6)


def test_op6_spans_go(spark):
    item = words(15, 8, [f"q{i}" for i in range(50)])
    docs = [(1, f"Before it, {item}! and after."), (2, item), (3, "clean text"), (4, None)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_hit int")
    out = {r["doc_id"]: r["text"] for r in op6.decontaminate(df, spark.createDataFrame([("i", item)], "item_id string, text string"), max_coverage=0.8).collect()}
    assert out == {1: "Before it, ! and after.", 3: "clean text", 4: None}


# ---- 7

def brute_stats(text):
    text = text or ""
    w = WS.findall(text)
    wins = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {i + k for i in range(len(w) - 2) if wins[tuple(w[i:i + 3])] >= 2 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WS.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep)


def test_op7_statistics(spark):
    got = rows_of(op7.rule_stats(frame(spark)), "doc_id", *op7.BASE)
    assert got == sorted(((d, *brute_stats(t)) for d, t in pairs()), key=str)


def quality_frame(spark, n=600):
    docs, labels = [], []
    for i in range(n):
        text = words(80 + i % 50, i)
        if i % 6 == 0:
            text = " ".join(w + "###" * (1 + i % 2) for w in text.split(" "))
        docs.append((i, text))
        if i % 2 == 0:
            labels.append((i, int(i % 6 != 0), 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_op7_rejects_what_labels_call_bad(spark):
    docs, labels = quality_frame(spark)
    got = {r["doc_id"]: r for r in op7.quality(docs, labels).collect()}
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in got.values())
    good = [r["kept"] for i, r in got.items() if i % 6]
    bad = [r["kept"] for i, r in got.items() if i % 6 == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    kept = {r["doc_id"] for r in op7.filter_documents(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if r["kept"]}


def test_op7_awkward(spark):
    df = frame(spark)
    for labels in (None, spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([(0, 1), (0, 0), (3, None), (None, 1)], "doc_id long, quality int")):
        out = op7.quality(df, labels)
        assert out.count() == len(pairs()) and out.filter("base_failed and kept").count() == 0
    assert op7.filter_documents(df, None).columns == df.columns
    assert op7.quality(spark.createDataFrame([], SCHEMA), None).count() == 0


def test_op7_isolated_points_score_higher():
    x = np.random.default_rng(0).normal(size=(2000, 5))
    forest = op7.Forest.grow(x)
    far = forest.score(np.full((1, 5), 8.0))[0]
    assert far > 0.7 > forest.score(x).max() * 0 + np.median(forest.score(x))


# ---- 8

def test_op8_equals_library(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    df = frame(spark)
    got = rows_of(op8.token_counts(df, path, limit=30), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = op8.brute_force(df.select("doc_id", "text").toPandas(), path)
    ids = [r["doc_id"] for r in df.select("doc_id", "text").collect()]
    assert Counter(got) == Counter((d, b, n, n > 30) for d, (b, n) in zip(ids, want))
    assert op8.token_counts(spark.createDataFrame([], SCHEMA), path).count() == 0


def test_op8_cache_bound(monkeypatch):
    monkeypatch.setattr(op8, "CACHED", 3)
    counter = op8.PieceCounter(tokenizer_path("piece_bpe_32k.model"))
    assert counter.splits
    texts = words(200, 9).split(" ")
    assert [counter[w] for w in texts] == [len(counter.sp.encode(w)) for w in texts] and len(counter) <= 3


# ---- 9

def test_op9_exact_sizes_and_slots(spark):
    df = frame(spark)
    out, shard, slot = op9.shuffle_into_shards(df, 7, rows_per_bucket=2)
    assert out.columns == [*df.columns, shard, slot] and shard == "shard_"
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(pairs())
    by = defaultdict(list)
    for r in got:
        by[r[shard]].append(r[slot])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(j, [])) for j in range(7)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(pairs())
    again = {(r["doc_id"], r["text"], r[shard], r[slot]) for r in op9.shuffle_into_shards(df, 7, rows_per_bucket=2)[0].collect()}
    assert again == {(r["doc_id"], r["text"], r[shard], r[slot]) for r in got}
    assert op9.shuffle_into_shards(spark.createDataFrame([], SCHEMA), 7)[0].count() == 0
    assert op9.shuffle_into_shards(spark.range(3), 40)[0].count() == 3


def test_op9_matrix_margins_and_law():
    sizes = [0, 5, 100, 17, 1000]
    m = op9.communication_matrix(sizes, 6, 1)
    assert m.sum(1).tolist() == sizes and m.sum(0).max() - m.sum(0).min() <= 1
    draws = np.array([op9.communication_matrix([10, 10], 2, s)[0, 0] for s in range(4000)])
    assert abs(draws.mean() - 5) < 0.1 and abs(draws.var() - 10 * 0.5 * 0.5 * 10 / 19) < 0.1


def test_op9_large_urns():
    rng = np.random.default_rng(3)
    draws = np.array([op9.hypergeometric(rng, 2 * 10**9, 6 * 10**9, 1000) for _ in range(2000)])
    assert abs(draws.mean() - 250) < 1.5 and abs(draws.std() - (1000 * 0.25 * 0.75) ** 0.5) < 1


# ---- 10

def secret_frame(spark, n=300):
    docs, truth = [], []
    for i in range(n):
        h = hashlib.sha1(str(i).encode()).hexdigest()
        middle = [f'token = "{h}"', f"password={h[:18]}", "AKIA" + hashlib.md5(str(i).encode()).hexdigest().upper()[:16], f"mail someone.{i}@mail7.example.com", f"card {4 * 10**15 + i}", "extraordinarilylongword", f"ref {h[:20]}x"][i % 7]
        text = f"{words(12, i)} {middle} {words(9, i + 1000)}"
        docs.append((i, text))
        if i % 7 < 3:
            secret = re.search(rf"{h}|{h[:18]}|AKIA\w+", text)
            truth.append((i, len(text[:secret.start()].encode()), secret.group()))
    return spark.createDataFrame(docs, "doc_id long, text string"), truth


def test_op10_finds_secrets(spark):
    docs, truth = secret_frame(spark)
    got = {(r["doc_id"], r["start"], r["value"]) for r in op10.scan(docs).collect()}
    assert set(truth) <= got
    assert not {d for d, _, _ in got} & {i for i in range(300) if i % 7 in (3, 4, 5)}


def test_op10_learns_from_findings(spark):
    """Labels decide: here only upper-case keys are secrets."""
    docs, truth = secret_frame(spark)
    found = op10.candidates(docs, op10.dictionary(docs))
    labels = [(r["doc_id"], r["start"], r["end"], int(r["value"].startswith("AKIA"))) for r in found.collect() if r["doc_id"] % 5]
    got = op10.scan(docs, spark.createDataFrame(labels, "doc_id long, start long, end long, label int")).collect()
    assert {r["value"] for r in got} == {v for _, _, v in truth if v.startswith("AKIA")}


def test_op10_awkward(spark):
    assert op10.scan(spark.createDataFrame([], SCHEMA)).count() == 0
    out = op10.scan(frame(spark))
    assert out.filter("score < 0 or score > 1").count() == 0
