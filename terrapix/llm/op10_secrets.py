"""10. Secret scans: a random forest removes the false positives.

Candidates are the values after an assignment (``=`` or ``:``) or a credential
name, of any length, and runs without such context of at least ``MIN_LENGTH``
characters a secret may consist of.  A value reaches to its closing quote or to
white space; where its end is uncertain (punctuation at the end, ``&``, ``;`` or
``,`` inside, a long run cut at another mark) each possible end is a candidate.
Each is described by its length, character classes and transitions, dictionary coverage,
path marks and neighbouring words; a random forest trained from labelled
findings (spark.ml) gives its probability of being a secret.

The dictionary is the ``DICTIONARY`` words most frequent over all documents
(ties by the word), whatever their partitions: every word is counted.
Labelled findings are a parameter (doc_id, start, end, label).  Where there are
none, ``weak_labels`` labels the candidates whose nature is certain: known key
formats and credential assignments against e-mail addresses, plain words and
plain numbers; all others stay unlabelled and are decided by the forest.  It is
trained on a bounded sample, the ``PER_CLASS`` findings of each label with the
smallest hash, in one fixed order, so the model does not depend on the cluster.

Defined cases: null and empty texts have no candidates; findings of repeated
rows repeat; without labelled findings of both kinds every candidate is
returned with score 1; an empty table gives an empty result; extra columns are
ignored.  Offsets count bytes of the UTF-8 text.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.smallest import smallest
from terrapix.llm.store import written
from terrapix.llm.worker import release, small_batches

MIN_LENGTH, DICTIONARY, PER_CLASS, TREES, DEPTH, SEED = 16, 20_000, 10_000, 60, 8, 11
TRACKED = 100_000
_CHARS = np.ones(256, bool)
_CHARS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"_+/=.-@"]] = False
#: fixed values: names under which credentials are commonly assigned, key formats
CUES = frozenset("password passwd pwd token secret key apikey api_key access_key auth bearer credential".split())
KEY_FORMAT = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[\w-]+\.[\w-]+\.[\w-]+")
_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
_MAIL = re.compile(r"[\w.+-]+@[\w-]+(\.[\w-]+)+\.?")
_WORD = re.compile(r"[A-Za-z]{3,}")
_CUE = "|".join(sorted(CUES, key=len, reverse=True)).encode()
#: a credential name with or without an assignment, or an assignment alone
_CONTEXT = re.compile(rb"(?<![A-Za-z0-9])(" + _CUE + rb")(?:[\"'`]?[ \t]*[=:]+>?[ \t]*|[\"'`]?[ \t]+(?![ \t=:]))|[=:]+>?[ \t]*", re.I)
_QUOTED, _BARE = re.compile(rb"\"([^\"\r\n]+)\"|'([^'\r\n]+)'"), re.compile(rb"[^\s\"']*")
_PART, _NEXT, _NAME = re.compile(rb"[&;,\s]"), re.compile(rb"[=:]+"), re.compile(r"[a-z0-9_]+$")
FEATURES = ["length", "digits", "upper", "lower", "hex", "marks", "switches", "entropy", "bigrams", "coverage", "slashes", "dots", "at", "assigned", "quoted", "cue", "word_before", "word_after"]


def _summaries(batches):
    """Counts of each task's words of three letters or more; when ``TRACKED``
    words are held, all are given out and counting starts anew, so a word may
    come several times."""
    seen: Counter[str] = Counter()

    def counts():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
    for b in batches:
        for t in b.column(0).to_pylist():
            if t:
                seen.update(w for w in t.lower().split() if w.isalpha() and 3 <= len(w) <= 24)
                if len(seen) >= TRACKED:
                    yield counts()
                    seen.clear()
    yield counts()


def dictionary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The ``DICTIONARY`` words most frequent; words that many tasks know are cut
    to about that number by histograms before any reaches the driver."""
    counts = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_summaries, "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")))
    head = F.expr("cast(conv(rpad(hex(substring(cast(word AS binary), 1, 7)), 14, '0'), 16, 10) AS bigint)")  # ordered as the words
    top = smallest(written(counts, "secret-words").withColumns({"_often": -F.col("n"), "_head": head}), ["_often", "_head"], DICTIONARY)
    return top.orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word").toPandas()["word"].tolist()


class Describer:
    """Features of a candidate, given the dictionary."""

    def __init__(self, words: list[str]):
        self.words = frozenset(words)
        self.longest = max(map(len, words), default=0)
        pairs = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
        total = sum(pairs.values()) or 1
        self.pairs = {p: math.log(n / total) for p, n in pairs.items()}
        self.floor = math.log(0.5 / total)

    def coverage(self, text: str) -> float:
        """Share of characters in dictionary words, longest first from the left."""
        i = covered = 0
        while i < len(text):
            for k in range(min(self.longest, len(text) - i), 2, -1):
                if text[i:i + k] in self.words:
                    covered += k
                    i += k - 1
                    break
            i += 1
        return covered / max(len(text), 1)

    def features(self, value: str, assigned: bool, quoted: bool, before: str, after: str, name: str) -> list[float]:
        n = len(value)
        low = value.lower()
        kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in value]
        share = Counter(kinds)
        counts = Counter(value).values()
        letters = [low[i:i + 2] for i in range(n - 1) if low[i:i + 2].isalpha()]
        return [
            float(n), share["d"] / n, share["u"] / n, share["l"] / n, sum(c in "0123456789abcdef" for c in low) / n, share["m"] / n,
            sum(a != b for a, b in zip(kinds, kinds[1:])) / n, -sum(c / n * math.log2(c / n) for c in counts),
            sum(self.pairs.get(p, self.floor) for p in letters) / len(letters) if letters else self.floor, self.coverage(low),
            float(value.count("/")), float(value.count(".")), float("@" in value), float(assigned), float(quoted),
            float(name in CUES or before in CUES), float(before in self.words), float(after in self.words),
        ]


def candidates(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, end, value, weak_label and the features of every candidate."""
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(words)  # DICTIONARY words at most

    def run(batches):
        release()
        describer = Describer(shared.value)
        for b in batches:
            rows, out = [], []
            for r0, _, buf, off in tv.chunks(b.column(1)):
                s, e, first = tv.word_spans(buf, off, _CHARS)
                at = np.flatnonzero(e - s >= MIN_LENGTH)
                row = np.searchsorted(first, at, "right") - 1
                runs: dict[int, list[int]] = {}
                for k, r in zip(at.tolist(), row.tolist()):
                    runs.setdefault(r, []).append(k)
                for r in range(len(off) - 1):
                    a, z = int(off[r]), int(off[r + 1])
                    found = {}
                    for k in runs.get(r, ()):
                        one = _describe(describer, buf, a, z, int(s[k]), int(e[k]))
                        if one:
                            found[one[:2]] = one
                    text = buf[a:z].tobytes()
                    for span in sorted(_values(text) - found.keys()):
                        found[span] = _describe_value(describer, text, *span)
                    rows += [r0 + r] * len(found)
                    out += found.values()
            cols = [b.column(0).take(pa.array(rows, pa.int64()))]
            for i, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int32())):
                cols.append(pa.array([o[i] for o in out], kind))
            cols += [pa.array([o[4][i] for o in out], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "end", "value", "weak_label", *FEATURES])
    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, start long, end long, value string, weak_label int, " + ", ".join(f"`{f}` double" for f in FEATURES))


def _values(text: bytes) -> set[tuple[int, int]]:
    """Spans of the values that follow an assignment or a credential name.

    Inside a value already given out, a later context gives the part up to the
    next sign of assignment, and only the first credential name in it gives more,
    so that all spans together grow with the text and not with its square."""
    spans = set()
    whole, part = [0, 0], [0, 0]  # ends of what was given out: by any context, by a credential name
    bare = mark = -1  # ends of the unquoted value and of the part without marks last looked up
    for m in _CONTEXT.finditer(text):
        quoted = _QUOTED.match(text, m.end())
        if quoted:
            start, end = quoted.span(quoted.lastindex)
        else:  # contexts come in order, so the end found by one holds for the next before it
            start = m.end() + (text[m.end():m.end() + 1] in (b'"', b"'"))
            if start >= bare:
                bare = _BARE.match(text, start).end()
            end = bare
        if start == end:
            continue
        named = m.group(1) is not None
        if start > mark or mark < 0:
            cut = _PART.search(text, start)
            mark = cut.start() if cut else len(text)
        stop = min(mark, end)
        sign = _NEXT.search(text, start, stop)
        ends = [sign.start() if sign and sign.end() < stop else stop] if not sign or sign.start() > start else []
        for reach, to in ((whole, end), (part, stop)):
            if start >= reach[0] or named and start >= reach[1]:
                ends.append(to)
                reach[0] = max(reach[0], to)
            if named:
                reach[1] = max(reach[1], to)
        for to in ends:
            spans.add((start, to))
            if not quoted and (short := len(text[start:to].rstrip(b".,;:)]}>"))):
                spans.add((start, start + short))
    return {(a, z) for a, z in spans if z > a}


def _describe_value(describer: Describer, text: bytes, start: int, end: int):
    """As ``_describe``, of the value of a context."""
    value = text[start:end].decode("utf-8", "replace")
    head = text[max(0, start - 80):start].decode("utf-8", "replace")
    after = text[end:end + 80].decode("utf-8", "replace").strip(" \t\"'").split()
    before = head.rstrip(" \t\"'`=:>").split()
    prev = before[-1].lower().strip("\"'") if before else ""
    following = after[0].lower().strip(".,;:!?") if after else ""
    name = _NAME.search(prev)
    name = name.group() if name else ""
    assigned = head.rstrip(" \t\"'").endswith(("=", ":", "=>", ":>"))
    features = describer.features(value, assigned, head.endswith(("\"", "'")), prev, following, name)
    return start, end, value, weak_label(value, assigned, name), features


def _describe(describer: Describer, buf: np.ndarray, row_start: int, row_end: int, s: int, e: int):
    """(start, end, value, weak label or None, features) of a run of bytes."""
    run = buf[s:e].tobytes().decode("ascii")
    body = run.rstrip(".")
    name, eq, value = body.rstrip("=").rpartition("=")
    padding = len(body) - len(body.rstrip("="))
    value = (value if eq else body.rstrip("=")) + "=" * padding
    if len(value) < MIN_LENGTH:
        return None
    start = s + (len(name) + 1 if eq else 0)
    head = buf[max(row_start, s - 80):s].tobytes().decode("utf-8", "replace")
    tail = buf[e:min(row_end, e + 80)].tobytes().decode("utf-8", "replace")
    before = head.rstrip(" \t\"'=:").split()
    after = tail.strip(" \t\"'").split()
    prev = before[-1].lower().strip("\"'") if before else ""
    following = after[0].lower().strip(".,;:!?") if after else ""
    assigned = bool(eq) or head.rstrip(" \t\"'").endswith(("=", ":"))
    features = describer.features(value, assigned, head.endswith(("\"", "'")), prev, following, name.lower())
    return start - row_start, start - row_start + len(value), value, weak_label(value, assigned, name.lower() or prev), features


def weak_label(value: str, assigned: bool, name: str) -> int | None:
    """1 and 0 for candidates whose nature is certain, None for the rest."""
    if assigned and name in CUES and len(value) < MIN_LENGTH:
        return None
    if KEY_FORMAT.fullmatch(value) or assigned and name in CUES and _HEX.fullmatch(value) and re.search(r"\d.*\d", value):
        return 1
    if _MAIL.fullmatch(value) or value.isdigit() or re.fullmatch(r"[A-Za-z]+([.\-/][A-Za-z]+)*", value):
        return 0
    return None


def _model(found: DataFrame):
    """The forest, or None when the labels are not of both kinds."""
    known = found.filter(F.col("label").isNotNull())
    known = known.withColumn("draw", F.xxhash64(F.lit(SEED), "value", "doc_id", "start")).withColumn("_short", F.shiftright("draw", 2))
    one, none = (smallest(known.filter(F.col("label") == i), ["_short"], PER_CLASS).orderBy("draw").limit(PER_CLASS) for i in (1, 0))
    sample = written(one.unionByName(none).select("label", "value", "doc_id", "start", *FEATURES).coalesce(1).sortWithinPartitions("value", "doc_id", "start"), "secret-sample").coalesce(1)
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.withColumn("label", F.col("label").cast("double")))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8).fit(rows)


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """The secrets found: doc_id, start, end, value, score."""
    small_batches(docs.sparkSession)
    found = written(candidates(docs, dictionary(docs, text_col), id_col, text_col), "secret-candidates")
    if findings is not None:
        said = findings.groupBy("doc_id", "start", "end").agg(F.max("label").cast("int").alias("label"))
        found = written(found.join(said, ["doc_id", "start", "end"], "left"), "secret-findings")
    else:
        found = found.withColumn("label", F.col("weak_label"))
    model = _model(found)
    if model is None:
        return found.select("doc_id", "start", "end", "value", F.lit(1.0).alias("score"))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    return (scored.select("doc_id", "start", "end", "value", vector_to_array("probability")[1].alias("score"))
            .filter(F.col("score") >= at_least))
