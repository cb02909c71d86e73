"""1. Token-ID / binary output: an adaptive context-mixing range coder.

Documents are dealt out in ascending id order (range partitions), encoded by
the ``tokenizers`` library, and their ids are written as blocks.  A block holds
whole documents, closes at ``BLOCK`` ids, is coded from a fresh model, and
carries crc32 sums of its ids and payload, so any block can be read alone.

Coder.  The ids of a block are cut into equal lanes that share one model and
advance together, so that numpy codes one id of every lane at a time:

* order-2 and order-1 contexts each predict one id, with a confidence;
* the joint confidence selects a mixing state, whose adaptive counts weigh the
  three orders: "order 2 is right", "order 1 is right", "order 0 decides";
* order 0 is an adaptive frequency table, rebuilt each time the coded part has
  doubled, with a Good-Turing escape for ids not seen so far.

Each lane has its own 64-bit carry-less range coder emitting 16-bit words.

Files.  Blocks are rows of a Parquet table (part, block, start within the part,
documents with their lengths, payload), so Spark's commit protocol protects
them and any store that Spark reads will do.

Defined cases: null and empty texts are encoded as the end id alone; equal doc
ids are ordered by their text's hash, equal rows stand next to each other; null
ids come first; a document longer than a block makes a longer block; an empty
table gives no blocks and no rows; extra columns are not written.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapix.llm import textvec as tv
from terrapix.llm.store import new_folder
from terrapix.llm.worker import hold, release, small_batches

BLOCK, LANES, MIN_STEPS = 1 << 21, 16384, 128
MAGIC = b"TPX1"
_NONE = np.uint32(0xFFFFFFFF)  # no prediction; such an id is always escaped
_CTX2, _T0, _TM = 18, 17, 16
#: next trust after a miss (first eight) and after a hit
_TRUST = np.array([0, 0, 1, 1, 2, 2, 3, 3, 1, 2, 3, 4, 5, 6, 7, 7], np.uint8)
_TOP, _BOTTOM, _SHIFT = np.uint64(1 << 48), np.uint64(1 << 32), np.uint64(16)


class Mixer:
    """The model of one block; coder and decoder make the same calls."""

    def __init__(self, total: int):
        self.next1 = np.full(1 << 16, _NONE)
        self.next2 = np.full(1 << _CTX2, _NONE)
        self.trust1 = np.zeros(1 << 16, np.uint8)
        self.trust2 = np.zeros(1 << _CTX2, np.uint8)
        self.bounds = np.zeros((256, 4), np.uint64)
        self.bounds[:, 3] = 1 << _TM
        self.events = np.tile(np.array([2, 1, 4], np.int64), 256)
        self.seen = np.zeros(1 << 16, np.int64)
        self.known = np.zeros(1 << 16, bool)
        self.counted = 0
        self.rebuild_at = 1
        self.order0(np.zeros(0, np.int64))
        self.weigh()

    def contexts(self, prev1: np.ndarray, prev2: np.ndarray):
        """For order 1 and order 2 the slots, predictions and their trust; the
        mixing state."""
        a = (prev1 & np.uint32(0xFFFF)).astype(np.intp)
        b = ((prev1 * np.uint32(0x9E3779B1) ^ prev2 * np.uint32(0x85EBCA77)) >> np.uint32(32 - _CTX2)).astype(np.intp)
        p1, p2, t1, t2 = self.next1.take(a), self.next2.take(b), self.trust1.take(a), self.trust2.take(b)
        state = ((t2.astype(np.intp) << 3 | t1) << 1) | (p1 == p2)
        return (a, p1, t1), (b, p2, t2), state

    def weigh(self) -> None:
        """Mixing weights of each state, out of 2**_TM."""
        e = self.events.reshape(-1, 3)
        scaled = 1 + e[:, :2] * ((1 << _TM) - 4) // e.sum(1, keepdims=True)
        self.bounds[:, 1] = scaled[:, 0]
        self.bounds[:, 2] = scaled[:, 0] + scaled[:, 1]
        self.starts, self.sizes = self.bounds[:, :3].ravel(), np.diff(self.bounds, axis=1).ravel()

    def learn(self, one, two, cell, ids) -> None:
        for (slot, p, t), nxt, trust in ((one, self.next1, self.trust1), (two, self.next2, self.trust2)):
            hit = p == ids
            nxt[slot] = np.where(t > 1, p, ids)  # of equal slots the last lane's value stays
            trust[slot] = _TRUST.take(hit.view(np.uint8) * np.uint8(8) + t)
        self.events += np.bincount(cell, minlength=768)
        if self.events.max() > 1 << 24:
            self.events = (self.events >> 1) + 1
        self.weigh()

    def order0(self, fresh: np.ndarray) -> None:
        """Count the ids coded since the last call and rebuild the table."""
        self.seen += np.bincount(fresh[fresh < 1 << 16], minlength=1 << 16)
        self.counted += len(fresh)
        ids = np.flatnonzero(self.seen)
        n = self.seen[ids]
        total, slots = int(n.sum()), 1 << _T0
        once = int((n == 1).sum())
        escape = slots if not total else min(max(64, slots * (once + 1) // (total + 2)), slots // 4)
        freq = 1 + n * (slots - escape - len(ids)) // max(total, 1)
        escape = slots - int(freq.sum())
        self.freq = np.zeros(1 << 16, np.uint64)
        self.start = np.zeros(1 << 16, np.uint64)
        self.freq[ids] = freq
        ends = np.cumsum(freq)
        self.start[ids] = ends - freq
        self.known = self.freq > 0
        self.escape_start, self.escape = slots - escape, escape
        self.slot_id = np.zeros(slots, np.uint32)
        self.slot_id[:slots - escape] = np.repeat(ids, freq)


class Lanes:
    """64-bit carry-less range coders side by side."""

    def __init__(self, n: int):
        self.low = np.zeros(n, np.uint64)
        self.range = np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64)

    def narrow(self, at, r, start, freq) -> None:
        """Code the interval (start, freq) in the lanes ``at``: their numbers,
        or a slice from the first lane on."""
        low, rng = self.low[at] + start * r, r * freq
        k, some_low, some_rng = None, low, rng
        while True:
            done = (some_low ^ (some_low + some_rng)) < _TOP
            tight = np.flatnonzero((some_rng < _BOTTOM) & ~done)
            if len(tight):
                some_rng[tight] = (np.uint64(0) - some_low[tight]) & (_BOTTOM - np.uint64(1))
                done[tight] = True
            j = np.flatnonzero(done)
            if k is not None:
                low[k], rng[k] = some_low, some_rng
            if not len(j):
                break
            k = j if k is None else k[j]
            some_low, some_rng = some_low[j], some_rng[j]
            self.shift(k if isinstance(at, slice) else at[k], some_low)
            some_low, some_rng = some_low << _SHIFT, some_rng << _SHIFT
        self.low[at], self.range[at] = low, rng


class Writer(Lanes):
    def __init__(self, n: int, steps: int):
        super().__init__(n)
        self.words = np.zeros((n, 4 * steps + 8), np.uint16)
        self.used = np.zeros(n, np.int64)

    def shift(self, at, low) -> None:
        self.words[at, self.used[at]] = (low >> np.uint64(48)).astype(np.uint16)
        self.used[at] += 1

    def put(self, at, start, freq, bits: int) -> None:
        self.narrow(at, self.range[at] >> np.uint64(bits), start, freq)

    def finish(self) -> tuple[np.ndarray, bytes]:
        value = (self.low + (_BOTTOM - np.uint64(1))) >> np.uint64(32)
        rows = np.arange(len(self.low))
        for k in (16, 0):
            self.words[rows, self.used] = (value >> np.uint64(k)).astype(np.uint16)
            self.used += 1
        keep = np.arange(self.words.shape[1]) < self.used[:, None]
        return self.used, self.words[keep].astype("<u2").tobytes()


class Reader(Lanes):
    def __init__(self, used: np.ndarray, payload: np.ndarray):
        super().__init__(len(used))
        self.payload = np.concatenate([payload, np.zeros(8, np.uint16)]).astype(np.uint64)
        self.at = np.concatenate([[0], np.cumsum(used)[:-1]])
        self.code = np.zeros(len(used), np.uint64)
        self.end = np.cumsum(used)
        for _ in range(4):
            self.next(np.arange(len(used)))

    def next(self, lanes) -> None:
        at = self.at[lanes]
        word = np.where(at < self.end[lanes], self.payload[np.minimum(at, len(self.payload) - 1)], np.uint64(0))
        self.code[lanes] = (self.code[lanes] << _SHIFT) | word
        self.at[lanes] = at + 1

    def shift(self, at, low) -> None:
        self.next(at)

    def peek(self, at, bits: int):
        r = self.range[at] >> np.uint64(bits)
        return r, np.minimum((self.code[at] - self.low[at]) // r, np.uint64((1 << bits) - 1))


def _shape(n: int) -> tuple[int, int]:
    """(lanes, steps): lanes are filled one after another, the last may be short."""
    steps = max(-(-n // LANES), min(MIN_STEPS, n))
    return -(-n // steps), steps


def pack(ids: np.ndarray) -> bytes:
    """One block of 32-bit ids, independent of all others."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    if not n:
        return MAGIC + struct.pack("<IIIII", 0, 0, 0, 0, 0)
    lanes, steps = _shape(n)
    wide = int(ids.max() >= 1 << 16)
    grid = np.zeros(lanes * steps, np.uint32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model, out = Mixer(n), Writer(lanes, steps)
    prev1 = prev2 = np.zeros(lanes, np.uint32)
    short = n - (lanes - 1) * steps
    for t in range(steps):
        m = lanes if t < short else lanes - 1
        at = slice(0, m)
        x = grid[t, :m]
        one, two, state = model.contexts(prev1[:m], prev2[:m])
        p1, p2 = one[1], two[1]
        miss = x != p2
        event = miss.astype(np.intp) + (miss & (x != p1)) if t else np.full(m, 2)
        cell = state * 3 + event
        out.put(at, model.starts.take(cell), model.sizes.take(cell), _TM)
        rest = np.flatnonzero(event == 2)
        if len(rest):
            y = x[rest].astype(np.intp)
            low16 = y & 0xFFFF
            known = model.known[low16] & (y < 1 << 16)
            out.put(rest, np.where(known, model.start[low16], np.uint64(model.escape_start)), np.where(known, model.freq[low16], np.uint64(model.escape)), _T0)
            raw = rest[~known]
            if len(raw):
                unit = np.ones(len(raw), np.uint64)
                if wide:
                    out.put(raw, (x[raw] >> np.uint32(16)).astype(np.uint64), unit, 16)
                out.put(raw, (x[raw] & np.uint32(0xFFFF)).astype(np.uint64), unit, 16)
        model.learn(one, two, cell, x)
        prev2, prev1 = prev1[:m], x
        if t + 1 == model.rebuild_at:
            model.order0(grid[t // 2 + (t > 0):t + 1].ravel().astype(np.int64))
            model.rebuild_at *= 2
    used, payload = out.finish()
    body = used.astype("<u4").tobytes() + payload
    return MAGIC + struct.pack("<IIIII", n, lanes, wide, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


def unpack(block: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError when it is damaged."""
    block = bytes(block)
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    n, lanes, wide, crc, body_crc = struct.unpack("<IIIII", block[4:24])
    if zlib.crc32(block[24:]) != (body_crc if n else 0):
        raise ValueError("damaged token block: payload checksum")
    if not n:
        return np.zeros(0, np.uint32)
    steps = _shape(n)[1]
    used = np.frombuffer(block, "<u4", lanes, 24).astype(np.int64)
    model, src = Mixer(n), Reader(used, np.frombuffer(block, "<u2", -1, 24 + 4 * lanes))
    grid = np.zeros((steps, lanes), np.uint32)
    prev1 = prev2 = np.zeros(lanes, np.uint32)
    short = n - (lanes - 1) * steps
    for t in range(steps):
        m = lanes if t < short else lanes - 1
        at = slice(0, m)
        one, two, state = model.contexts(prev1[:m], prev2[:m])
        p1, p2 = one[1], two[1]
        r, v = src.peek(at, _TM)
        cell = state * 3
        event = (v >= model.starts.take(cell + 1)).astype(np.intp) + (v >= model.starts.take(cell + 2))
        cell += event
        src.narrow(at, r, model.starts.take(cell), model.sizes.take(cell))
        x = np.where(event == 0, p2, p1)
        rest = np.flatnonzero(event == 2)
        if len(rest):
            r, v = src.peek(rest, _T0)
            known = v < np.uint64(model.escape_start)
            y = model.slot_id[v.astype(np.intp)]
            src.narrow(rest, r, np.where(known, model.start[y], np.uint64(model.escape_start)), np.where(known, model.freq[y], np.uint64(model.escape)))
            raw = np.flatnonzero(~known)
            if len(raw):
                lane = rest[raw]
                high = np.zeros(len(raw), np.uint32)
                for part in range(1 + wide):
                    r, v = src.peek(lane, 16)
                    src.narrow(lane, r, v, np.ones(len(raw), np.uint64))
                    high = (high << np.uint32(16)) | v.astype(np.uint32)
                y[raw] = high
            x[rest] = y
        grid[t, :m] = x
        model.learn(one, two, cell, x)
        prev2, prev1 = prev1[:m], x
        if t + 1 == model.rebuild_at:
            model.order0(grid[t // 2 + (t > 0):t + 1].ravel().astype(np.int64))
            model.rebuild_at *= 2
    ids = grid.T.ravel()[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("damaged token block: id checksum")
    return ids


#: words that a worker remembers; the slots of its hash table
CACHED, _SLOTS = 1 << 20, 22
_BLANK = np.zeros(256, bool)
_BLANK[0x20] = True
_WORDLY = np.zeros(256, bool)  # ASCII letters and digits
_WORDLY[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_MARK = _PRINTED & ~_WORDLY
#: longer runs of marks stay with their word
_MARKS = 8
#: tell a text's first word, and other pieces not led by a space, from words led by one
_HEAD, _TAIL = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level models write for bytes: printable Latin-1
    stands for itself, the rest for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words:
    """Encodes words and texts with the library.

    Under the byte-level pattern a single space before a character that is not
    white space always starts a new pre-token, so a text whose spaces are
    single is the concatenation of its space-led words; a word's pre-tokens are
    encoded one by one by the library's model.  A line break between characters
    that are not white space, and the marks at the end of a word after a letter
    or digit, are pre-tokens as well.  ``splits`` tells whether the given
    tokenizer passes a probe of this.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.model, self.cut = self.tok.model, self.tok.pre_tokenizer
        self.letters, self.space = _byte_letters(), _byte_letters()[0x20]
        probe = ["a\n b c\n\n d \te 1 2x 's it's", " x y", "a\t b", " a  b", "a \u3000b", "word, word. Zoë's Ünï-x 12,5 \U0001F642 \u00aa\u00b5"]
        try:
            self.splits = [self.whole(t) for t in probe if "  " not in t] == [self._split(t) for t in probe if "  " not in t]
            pieces = ["it's", "!?", "\n", "Äb", "%%%", "\n", "'s", "\n", "9", "..."]
            self.splits &= self.whole("a " + "".join(pieces)) == self.whole("a") + self.led(pieces[0]) + [i for x in pieces[1:] for i in self.bare(x)]
        except AttributeError:  # a tokenizer without these parts
            self.splits = False

    def whole(self, text: str) -> list[int]:
        return self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _split(self, text: str) -> list[int]:
        head, *rest = text.split(" ")
        return (self.whole(head) if head else []) + [i for w in rest for i in self.led(w)]

    def _ids(self, pre_token: str) -> list[int]:
        return [t.id for t in self.model.tokenize(pre_token)]

    def led(self, word: str) -> list[int]:
        """The ids of a word led by a space."""
        if word.isalpha() and max(word) < "\u0250":  # one pre-token of Latin letters
            return self._ids(self.space + word.encode().decode("latin-1").translate(self.letters))
        return [i for part, _ in self.cut.pre_tokenize_str(" " + word) for i in self._ids(part)]

    def bare(self, piece: str) -> list[int]:
        """The ids of a piece that neither begins its text nor follows a space."""
        if piece.isalpha() and max(piece) < "\u0250":
            return self._ids(piece.encode().decode("latin-1").translate(self.letters))
        return [i for part, _ in self.cut.pre_tokenize_str(piece) for i in self._ids(part)]

    def plain(self, text: bytes) -> bool:
        """The text is the concatenation of its space-led words."""
        return self.splits and b"  " not in text and text[-1:] != b" " and not any(a in text for a in self.added)


class WordTable:
    """Ids of words in an open hash table of numpy arrays: all words of a chunk
    are looked up at once, by 128 bits of hash, and their ids gathered; only words
    not seen yet go through the library.  When the table is full, words met again
    since the last time stay.  Texts that are not plain are encoded whole."""

    def __init__(self, path: str):
        self.words = Words(path)
        self._clear()

    def _clear(self) -> None:
        self.slot = np.full(1 << _SLOTS, -1, np.int32)
        self.key = np.zeros((2, CACHED), np.uint64)
        self.begin, self.length, self.met = np.zeros(CACHED, np.int64), np.zeros(CACHED, np.int32), np.zeros(CACHED, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.n = self.used = 0

    def _find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The entry of each word, -1 for unknown words."""
        out = np.full(len(h1), -1, np.int64)
        at, live = (h1 >> np.uint64(64 - _SLOTS)).astype(np.int64), np.arange(len(h1))
        while len(live):
            entry = self.slot[at]
            there = entry >= 0
            live, at, entry = live[there], at[there], entry[there]
            same = (self.key[0][entry] == h1[live]) & (self.key[1][entry] == h2[live])
            out[live[same]] = entry[same]
            live, at = live[~same], (at[~same] + 1) & ((1 << _SLOTS) - 1)
        return out

    def _add(self, h1: np.ndarray, h2: np.ndarray, ids: list[list[int]]) -> None:
        """New entries; the keys differ from each other and from those held."""
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
        new = np.arange(self.n, self.n + len(ids))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.key[0][new], self.key[1][new] = h1, h2
        self.begin[new], self.length[new], self.met[new] = self.used + np.cumsum(lengths) - lengths, lengths, 0
        self.n, self.used = self.n + len(ids), self.used + len(flat)
        self._place(new)

    def _place(self, new: np.ndarray) -> None:
        at = (self.key[0][new] >> np.uint64(64 - _SLOTS)).astype(np.int64)
        while len(new):
            free = self.slot[at] < 0
            self.slot[at[free]] = new[free]  # of several for a slot the last stays
            lost = self.slot[at] != new
            new, at = new[lost], (at[lost] + 1) & ((1 << _SLOTS) - 1)

    def _make_room(self, n: int) -> None:
        """Room for n more words: those met again stay, half the table at most."""
        if self.n + n <= CACHED:
            return
        kept = np.flatnonzero(self.met[:self.n] > 1)  # in two parts or more
        if len(kept) > CACHED // 2 or len(kept) + n > CACHED:
            kept = kept[:0]
        key, lengths = self.key[:, kept].copy(), self.length[kept]
        ids = self.ids[_ragged(self.begin[kept], lengths)]
        self._clear()
        m = len(kept)
        while len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[:len(ids)] = ids
        self.key[:, :m], self.begin[:m], self.length[:m] = key, np.cumsum(lengths) - lengths, lengths
        self.n, self.used = m, len(ids)
        self._place(np.arange(m))

    def rows(self, buf: np.ndarray, off: np.ndarray) -> list[bytes]:
        """The ids of each text of a chunk as little-endian 32-bit numbers."""
        raw = buf.tobytes()
        n = len(off) - 1
        texts = [raw[off[r]:off[r + 1]] for r in range(n)]
        plain = np.array([self.words.plain(t) for t in texts], bool)
        starts, ends, first = tv.word_spans(buf, off, _BLANK)
        row = np.repeat(np.arange(n), np.diff(first))
        use = plain[row]
        starts, ends, row = starts[use], ends[use], row[use]
        starts, ends, row, led = _pieces(buf, off, starts, ends, row)
        h1, h2 = (tv.span_hashes(buf, starts, ends, lower=False, which=k) if len(starts) else np.zeros(0, np.uint64) for k in (0, 1))
        kinds = np.where(starts == off[row], 1, np.where(led, 0, 2))
        for kind, salt in ((1, _HEAD), (2, _TAIL)):
            h1[kinds == kind] ^= salt
            h2[kinds == kind] ^= salt
        out: list[bytes] = [b""] * n
        step = CACHED // 4  # a chunk of few, very long texts may have more words than the table
        ids, sizes = [], np.zeros(n, np.int64)
        for a in range(0, len(h1), step):
            part = slice(a, a + step)
            entry = self._find(h1[part], h2[part])
            missing = np.flatnonzero(entry < 0)
            if len(missing):
                _, one = np.unique(h1[part][missing], return_index=True)
                at = missing[one] + a
                if self.n + len(at) > CACHED:
                    self._make_room(len(at) + step)
                    entry = self._find(h1[part], h2[part])
                    at = np.flatnonzero(entry < 0)
                    at = at[np.unique(h1[part][at], return_index=True)[1]] + a
                encode = (self.words.led, self.words.whole, self.words.bare)
                self._add(h1[at], h2[at], [encode[k](raw[s:e].decode("utf-8", "replace")) for s, e, k in zip(starts[at].tolist(), ends[at].tolist(), kinds[at].tolist())])
                entry = self._find(h1[part], h2[part])
            self.met[entry] += 1
            lengths = self.length[entry]
            ids.append(self.ids[_ragged(self.begin[entry], lengths)])
            sizes += np.bincount(row[part], lengths, minlength=n).astype(np.int64)
        flat = np.concatenate(ids).astype("<u4").tobytes() if ids else b""
        stop = 4 * np.cumsum(sizes)
        for r in range(n):
            out[r] = flat[stop[r] - 4 * sizes[r]:stop[r]] if plain[r] else np.array(self.words.whole(texts[r].decode("utf-8", "replace")), "<u4").tobytes()
        return out


def _wordly(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """An ASCII letter or digit, or a letter of two bytes up to U+00FF, ends at each position."""
    last = buf[at]
    return _WORDLY[last] | (buf[np.maximum(at - 1, 0)] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)


def _pieces(buf: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray):
    """Words cut at line breaks between characters that are not white space, and
    before the marks that end them: starts, ends, rows and whether led by a space."""
    if not len(starts):
        return starts, ends, row, np.zeros(0, bool)
    at = np.flatnonzero(buf == 0x0A)
    word = np.searchsorted(starts, at, "right") - 1
    inside = (word >= 0) & (at > starts[word]) & (at + 1 < ends[word])
    at, word = at[inside], word[inside]
    fit = (_PRINTED[buf[at - 1]] | _wordly(buf, at - 1) & (at - 2 >= starts[word])) & (_PRINTED[buf[at + 1]] | (buf[at + 1] == 0xC3))
    at, word = at[fit], word[fit]
    led = np.concatenate([np.ones(len(starts), bool), np.zeros(2 * len(at), bool)])
    starts, rows = np.concatenate([starts, at, at + 1]), np.concatenate([row, row[word], row[word]])
    order = np.argsort(starts, kind="stable")
    starts, row, led, ends = starts[order], rows[order], led[order], np.sort(np.concatenate([ends, at, at + 1]))
    # marks at the end
    body, live = ends.copy(), np.arange(len(ends))
    for _ in range(_MARKS):
        live = live[(body[live] - starts[live] > 1) & _MARK[buf[body[live] - 1]]]
        body[live] -= 1
    marked = (body < ends) & _wordly(buf, body - 1) & (_WORDLY[buf[body - 1]] | (body - starts > 1))
    of = np.repeat(np.arange(len(starts)), 1 + marked)
    tail = np.zeros(len(of), bool)
    tail[1:] = of[1:] == of[:-1]
    body = np.where(marked, body, ends)
    return np.where(tail, body[of], starts[of]), np.where(tail, ends[of], body[of]), row[of], led[of] & ~tail


def _ragged(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers begin .. begin + length - 1 of each entry, in a row."""
    total = np.cumsum(lengths, dtype=np.int64)
    return np.repeat(begin - (total - lengths), lengths) + np.arange(int(total[-1]) if len(total) else 0)


def encoder(path: str) -> WordTable:
    return hold(f"words of {path}", lambda: WordTable(path))


def _pack_partition(path: str, end_id: int):
    end = struct.pack("<I", end_id)

    def run(batches):
        enc, part = encoder(path), TaskContext.get().partitionId()
        docs, ids, held, block, start = [], [], 0, 0, 0
        kind = None

        def close():
            sizes = [len(x) // 4 for x in ids]
            payload = pack(np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([start], pa.int64()), pa.array([held], pa.int64()),
                pa.array([docs], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                ["part", "block", "start", "n_tokens", "doc_ids", "doc_tokens", "payload"])
        for b in batches:
            kind = b.schema.field(0).type
            for i, j, buf, off in tv.chunks(b.column(1)):
                for doc, one in zip(b.column(0)[i:j].to_pylist(), enc.rows(buf, off)):
                    docs.append(doc)
                    ids.append(one + end)
                    held += len(one) // 4 + 1
                    if held >= BLOCK:
                        yield close()
                        start, block = start + held, block + 1
                        docs, ids, held = [], [], 0
        if docs:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token blocks of ``docs`` in ascending id order to ``path``."""
    small_batches(docs.sparkSession)
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    ordered = thin.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    (ordered.mapInArrow(_pack_partition(tokenizer, end_id), f"part int, block long, start long, n_tokens long, doc_ids array<{kind}>, doc_tokens array<long>, payload binary")
     .write.mode("overwrite").parquet(path))


def _part_offsets(blocks: DataFrame) -> DataFrame:
    """Ids before each part: one row for each writing task."""
    sizes = sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    rows, total = [], 0
    for part, n in sizes:
        rows.append((part, total))
        total += n
    return blocks.sparkSession.createDataFrame(rows, "part int, before long")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Read a token table back, one row per document: doc_id, start, n_tokens,
    ids_crc32, and the ids themselves on demand."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        release()
        for b in batches:
            for i in range(b.num_rows):
                before, docs, sizes, payload = (b.column(k)[i] for k in range(4))
                ids = unpack(payload.as_py()).astype("<u4")
                n = np.array(sizes.as_py(), np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                cuts = [raw[4 * (z - k):4 * z] for z, k in zip(ends.tolist(), n.tolist())]
                cols = [docs.values, pa.array(before.as_py() + ends - n), pa.array(n), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(c, "<u4").astype(np.int64) for c in cuts], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])
    placed = (blocks.join(F.broadcast(_part_offsets(blocks)), "part")  # one row for each part
              .select((F.col("before") + F.col("start")).alias("start"), "doc_ids", "doc_tokens", "payload"))
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` below the shared folder and read the files back."""
    spark = docs.sparkSession
    path = new_folder(spark, f"tokens-{uuid.uuid4().hex[:8]}")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(spark, path)
