"""4. SentencePiece encoding and decoding: a weighted finite-state transducer.

A model is compiled into three transducers that are composed with each input:

* the normaliser: spaces become the word mark, one mark is put in front;
* the pieces: an arc for every piece, reading its characters, writing its id;
* byte fallback: an arc for every character that no piece covers, writing the
  ids of its UTF-8 bytes.

The shortest path in the tropical semiring (weights add along a path, the least
total wins) is the encoding.  For a unigram model an arc weighs the negated
score.  For a BPE model the states remember the last piece: an arc to a piece
that merging would not have left next to it weighs infinity, all others weigh 0.
A sequence of pieces is what merging produces exactly if each adjacent pair is,
so one path of finite weight remains: it is searched depth first, the longest arc
first, and a position that no such path goes on from is not entered again.

Composition runs on the parts of a text: no piece crosses from a character to a
word mark, nor between two characters that never stand side by side in a piece,
so paths of parts concatenate.  Parts are remembered in two generations of a
bounded cache in each worker.

Supported are models with the identity normaliser, marks for spaces and byte
fallback; others are refused when they are compiled.

Defined cases: null and empty texts have no ids and decode to empty text; ids
decode to the normalised text, which for the identity normaliser is the text;
repeated rows are encoded each; an empty table gives an empty result; other
columns are carried and added names never clash.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.worker import hold, small_batches

_MARK = "▁"
#: words in each of the two generations of a worker's cache, parts, and pairs of
#: pieces remembered: about 100 MB in all, let go when another operator runs in the worker
CACHED, PARTS, PAIRS = 120_000, 120_000, 200_000
UNIGRAM, BPE, _UNKNOWN = 1, 2, 1e6


def _fields(raw: bytes) -> dict[int, list]:
    """The fields of a protocol buffer message: numbers and byte strings."""
    out: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value
    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value, at = raw[at:at + size], at + size
        out.setdefault(key >> 3, []).append(value)
    return out


class Words(dict):
    """word -> ids of the word led by a mark, in two generations."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, word: str) -> bytes:
        done = self.old.get(word)
        if done is None:
            done = self.encode(_MARK + word)
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[word] = done
        return done


class Transducer:
    """A compiled model."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = _fields(sp.serialized_model_proto())
        trainer, normal = _fields(proto[2][0]), _fields(proto[3][0])
        # fixed field numbers of the published model format
        self.kind = trainer.get(3, [UNIGRAM])[0]
        identity = not normal.get(2, [b""])[0] and normal.get(4, [1])[0] == 0 and normal.get(5, [1])[0] == 1
        if self.kind not in (UNIGRAM, BPE) or not identity or not trainer.get(35, [0])[0]:
            raise ValueError("only unigram and BPE models with identity normaliser and byte fallback are supported")
        self.prefix = bool(normal.get(3, [1])[0])
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.weight = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [0] * 256
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:5], 16)] = i
        # merging order: single characters are there from the start
        self.rank = {p: (0 if len(p) == 1 else 1 + w) for p, w in self.weight.items()}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.side = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(a != _MARK and b == _MARK for a, b in self.side):
            raise ValueError("pieces with inner word marks are not supported")
        # beginnings of longer pieces (1), pieces (2)
        self.arcs = dict.fromkeys((p[:k] for p in self.ids for k in range(1, len(p))), 1)
        for p in self.ids:
            self.arcs[p] = self.arcs.get(p, 0) | 2
        # a character without a piece stands in no piece: the path of finite weight is the only one
        self.spelled = all(c in self.ids for p in self.ids for c in p)
        self.parts: dict[str, bytes] = {}
        self.words = Words(self._word)
        self.output = [b""] * n  # what decoding writes for an id
        for p, i in self.ids.items():
            self.output[i] = p.replace(_MARK, " ").encode()
        for value, i in enumerate(self.bytes):
            self.output[i] = bytes([value])

    # -- the weight of an arc of a BPE model

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two parts of the last merge that makes a piece, None for a
        character."""
        if len(piece) == 1:
            return None
        if piece not in self.splits:
            parts = list(piece)
            while len(parts) > 2:
                ranks = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
                k = int(np.argmin(ranks))
                if ranks[k] == np.inf:
                    break
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            self.splits[piece] = (parts[-2], parts[-1]) if len(parts) == 2 else ("", "")
        return self.splits[piece]

    def _adjacent(self, a: str, b: str) -> bool:
        """Whether merging leaves pieces a and b side by side: undo the later of
        the two last merges again and again, and see that no merge across the
        border would have come first."""
        limit, closed = np.inf, False  # closed: a merge of rank `limit` itself also comes first
        rank, left_done, right_done = self.rank, False, False
        while True:
            across = rank.get(a + b)
            if across is not None and (across < limit or closed and across == limit):
                return False
            sa, sb = self._split(a), self._split(b)
            left_done, right_done = sa is None, sb is None
            if left_done and right_done:
                return True
            if right_done or not left_done and rank[a] > rank[b]:
                limit, closed, a = rank[a], False, sa[1]
            else:
                # the border lies left of b, so an equal merge there comes first
                limit, closed, b = rank[b], True, sb[0]

    def joins(self, a: str, b: str) -> bool:
        key = (a, b)
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            ok = self.pairs[key] = self._adjacent(a, b)
        return ok

    # -- composition with an input and the shortest path

    def path(self, part: str) -> list[str]:
        """Pieces, and characters without a piece, of the shortest path.

        A state of the composition is a position and what the weights need of
        the way there.  A unigram model needs nothing; of a BPE model's ways to
        a position only one has finite weight (the merging of that beginning),
        so the last piece is known from the position.  Either way each position
        keeps one best predecessor.
        """
        if self.kind == BPE and self.spelled:
            return self._finite(part)
        n, ids, arcs = len(part), self.ids, self.arcs
        last: list[str | None] = [None] * (n + 1)
        weight = [np.inf] * (n + 1)
        weight[0] = 0.0
        merging, pairs, joins = self.kind == BPE, self.pairs, self.joins
        for i in range(n):
            before = last[i]
            if before is None and i:
                continue
            known = before in ids
            if part[i] not in ids:
                j = i + 1
                if merging or weight[i] + _UNKNOWN < weight[j]:
                    last[j], weight[j] = part[i], weight[i] + _UNKNOWN
            for j in range(i + 1, n + 1):
                piece = part[i:j]
                arc = arcs.get(piece, 0)
                if arc & 2:
                    if not merging:
                        w = weight[i] + self.weight[piece]
                        if w < weight[j]:
                            last[j], weight[j] = piece, w
                    elif last[j] is None and (not known or pairs.get((before, piece)) or joins(before, piece)):
                        last[j] = piece
                if not arc & 1:
                    break
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _finite(self, part: str) -> list[str]:
        """The path of a BPE model whose weight is finite. Of the ways to a position
        only one has finite weight, so whether it goes on to the end depends on the
        position alone: each is left for good once all its arcs were tried."""
        n, arc_of, pairs, joins = len(part), self.arcs.get, self.pairs, self.joins
        out: list[str] = []
        left: list[list[str]] = []  # arcs not yet tried, of each position of the way
        dead: set[int] = set()
        at, before = 0, None
        while at < n:
            tried = []
            for j in range(at + 1, n + 1):
                piece = part[at:j]
                arc = arc_of(piece, 0)
                if arc & 2 and j not in dead:
                    tried.append(piece)
                if not arc & 1:
                    break
            if not tried and not arc_of(part[at], 0) & 2:
                tried = [part[at]]  # a character without a piece
            while True:
                if tried:
                    piece = tried.pop()
                    if at + len(piece) not in dead and (before is None or pairs.get((before, piece)) or joins(before, piece)):
                        break
                else:
                    dead.add(at)
                    at -= len(out.pop())
                    tried, before = left.pop(), out[-1] if out else None
            left.append(tried)
            out.append(piece)
            at += len(piece)
            before = piece
        return out

    def _part(self, part: str) -> bytes:
        """The ids of a part, remembered."""
        done = self.parts.get(part)
        if done is None:
            ids = array("I")
            for piece in self.path(part):
                known = self.ids.get(piece)
                if known is not None:
                    ids.append(known)
                else:
                    ids.extend(self.bytes[x] for x in piece.encode())
            if sys.byteorder == "big":
                ids.byteswap()
            done = ids.tobytes()
            if len(self.parts) >= PARTS:
                self.parts.clear()
            self.parts[part] = done
        return done

    def _word(self, word: str) -> bytes:
        """A marked word: its parts between characters that no piece joins."""
        side = self.side
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1:i + 1] not in side), len(word)]
        if len(cuts) == 2:
            return self._part(word)
        return b"".join([self._part(word[a:z]) for a, z in zip(cuts, cuts[1:])])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        known = self.words.__getitem__
        out = []
        for t in texts:
            if not t:
                out.append(b"")
            elif self.prefix and t[0] != " " and t[-1] != " " and "  " not in t and _MARK not in t:
                out.append(b"".join(map(known, t.split(" "))))
            else:  # a run of marks belongs to the next word
                marked = (_MARK if self.prefix else "") + t.replace(" ", _MARK)
                out.append(b"".join(map(self._word, re.findall(f"{_MARK}+[^{_MARK}]*|[^{_MARK}]+", marked))))
        return out

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.output.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")[1 if self.prefix and raw[:1] == b" " else 0:]


def transducer(path: str) -> Transducer:
    return hold(f"transducer of {path}", lambda: Transducer(path))


def encode(docs: DataFrame, model: str, text_col: str = "text", with_decoded: bool = False) -> tuple[DataFrame, list[str]]:
    """``docs`` with its ids (little-endian 32-bit numbers) and, on demand, the
    text decoded from them; returns the frame and the added names."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    inner = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*inner).withColumn(inner[at], F.col(inner[at]).cast("string"))

    def run(batches):
        fst = transducer(model)
        for b in batches:
            for i, j, _, _ in tv.chunks(b.column(at)):
                ids = fst.encode(b.column(at)[i:j].to_pylist())
                cols = [*b.slice(i, j - i).columns, pa.array(ids, pa.binary())]
                if with_decoded:
                    cols.append(pa.array([fst.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[f"c{k}" for k in range(len(cols))])
    schema = ", ".join(f"{c} {plain.schema[c].dataType.simpleString()}" for c in inner) + f", c{len(inner)} binary" + f", c{len(inner) + 1} string" * with_decoded
    names = [_free(n, docs) for n in ("ids", "decoded")[:1 + with_decoded]]
    return plain.mapInArrow(run, schema).toDF(*docs.columns, *names), names


def decode(frame: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``frame`` with the column ``decoded`` from its ids."""
    def texts(ids: pa.Array) -> pa.Array:
        fst = transducer(model)
        return pa.array([fst.decode(x or b"") for x in ids.to_pylist()], pa.string())

    small_batches(frame.sparkSession)
    inner = [f"c{i}" for i in range(len(frame.columns))]
    at = frame.columns.index(ids_col)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, texts(b.column(at))], [*inner, f"c{len(inner)}"])
    plain = frame.toDF(*inner)
    schema = ", ".join(f"{c} {plain.schema[c].dataType.simpleString()}" for c in inner)
    return plain.mapInArrow(run, f"{schema}, c{len(inner)} string").toDF(*frame.columns, _free("decoded", frame))


def _free(name: str, df: DataFrame) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
