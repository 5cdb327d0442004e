"""Hierarchical multi-length packing (operator 5).

Every document becomes the ids of a public tokenizer and one end id.  The
context sizes are tiers (powers of two up to the window).  A task packs the
documents it has read, some 2**20 tokens at a time:

* a document's full windows are cut off; the rest goes to the smallest tier
  that holds it;
* from the longest tier down, each of a tier's documents opens a sequence of
  the tier's size; the gap is filled with the longest shorter pieces that
  fit, and what then is missing is cut from a shorter piece, whose rest goes
  back to its own tier;
* a sequence that nothing is left to fill is cut at the next shorter tier;
* what is left below the smallest tier waits for the next documents; only the
  last one of a task is padded (to the window).

So nearly every sequence has exactly the size of its tier and no padding.
Sequences are dealt to step groups of ``step_tokens`` tokens each, of one
tier where a tier has enough, so that each training step costs the same.

Packing is local to a task: no shuffle, memory bounded by the buffer and the
longest document.  A sequence's id carries its task's number, and a task that
runs again reads the same rows in the same order.

Null or empty texts are the end id alone.  A null id is carried as null.
Repeated rows are packed each by itself.  Ties in length go to the earlier
row.  Only the id and the text are read, so clashing names do not matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common as C

WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16 * WINDOW
BUFFER_TOKENS = 1 << 20
END_ID = 1
LONG_WORD = 256
KNOWN_WORDS, KNOWN_PARTS = 200_000, 600_000    # remembered by a worker; parts cost more to learn again


# Fixed value: the tokenizer's own word pattern, for which ALL_PLAIN and PARTS hold.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words of printable ASCII and Latin-1 letters: lower-casing and composing them is plain.
ALL_PLAIN = re.compile(r"[\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*\Z")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\n|[^\na-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
WORD_END = 0xFFFFFFFF    # no id; stands for the line break after each of many words
LINE_BREAK = {"\n": WORD_END.to_bytes(4, "little")}
PARTS_AT_ONCE = 400
GATHERED = 1 << 18       # words of a text whose ids are gathered together


class WordIds:
    """Ids of whole texts, word by word: white space always ends a token here.

    The tokenizer's pattern never crosses white space and drops it, so a
    text's ids are its words' ids in order.  The distinct words of some texts
    are looked up once.  A plain word is put together from its parts (runs
    of letters, single digits, runs of other characters), which repeat more
    often than words; parts are encoded many at a time and told apart by the
    vocabulary's word ends.  All other words are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = dict(LINE_BREAK)
        spec = json.loads(self.tokenizer.to_str())
        end = spec["model"].get("end_of_word_suffix")
        self.plain = bool(end) and WORD_PATTERN in json.dumps(spec["pre_tokenizer"]).encode().decode("unicode_escape").replace("\\\\", "\\")
        if self.plain:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(end)]] = True

    def _one_by_one(self, words: list[str]):
        for at in range(0, len(words), 4096):
            for e in self.tokenizer.encode_batch(words[at:at + 4096], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()

    def _learn_parts(self, new: list[str]) -> None:
        for at in range(0, len(new), PARTS_AT_ONCE):
            some = new[at:at + PARTS_AT_ONCE]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) == len(some):
                raw = ids.tobytes()
                ends = ends.tolist()
                self.parts.update((w, raw[a:b]) for w, a, b in zip(some, [0, *ends], ends))
            else:
                self.parts.update(zip(some, self._one_by_one(some), strict=True))

    def encode(self, texts: list[bytes] | pa.Array) -> list[bytes]:
        codes, words, sizes = C.split_words(pa.array(texts, pa.binary()) if isinstance(texts, list) else texts)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        if len(self.parts) > KNOWN_PARTS:
            self.parts = dict(LINE_BREAK)
        plain, other, lowered = np.arange(len(words)), [], b"\n".join(words).decode("utf-8", "replace")
        if self.plain and ALL_PLAIN.match(lowered) and "<|" not in lowered and max(map(len, words), default=0) <= LONG_WORD:
            lowered = lowered.lower()
        else:
            plain, some = [], []
            for i, w in enumerate(words):
                text = w.decode("utf-8", "replace")
                if self.plain and len(w) <= LONG_WORD and ALL_PLAIN.match(text) and "<|" not in text:
                    plain.append(i)
                    some.append(text.lower())
                else:
                    other.append(i)
            lowered = "\n".join(some)
        # the ids of the distinct words one after another: first of the plain ones, each with its end
        found = PARTS.findall(lowered + "\n") if len(plain) else []
        self._learn_parts(list(set(found).difference(self.parts)))
        pool = np.frombuffer(b"".join(map(self.parts.__getitem__, found)), "<u4")
        ends = np.flatnonzero(pool == WORD_END)
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[plain] = np.r_[0, ends + 1][:-1]
        lengths[plain] = ends - starts[plain]
        if other:
            new = [words[i] for i in other if words[i] not in self.known]
            now = dict(zip(new, self._one_by_one([w.decode("utf-8", "replace") for w in new]), strict=True))
            found = [now[words[i]] if words[i] in now else self.known[words[i]] for i in other]
            self.known.update((w, ids) for w, ids in now.items() if len(w) <= LONG_WORD)
            lengths[other] = np.fromiter(map(len, found), np.int64, len(found)) // 4
            starts[other] = len(pool) + np.cumsum(lengths[other]) - lengths[other]
            pool = np.concatenate([pool, np.frombuffer(b"".join(found), "<u4")])
        out, at = [], np.r_[0, np.cumsum(sizes)]
        for a, b in zip(at[:-1], at[1:]):
            out.append(b"".join(self._gathered(pool, starts, lengths, codes[k:min(k + GATHERED, b)]) for k in range(a, b, GATHERED)))
        return out

    @staticmethod
    def _gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
        n = np.take(lengths, codes)
        places = np.repeat(np.take(starts, codes) - (np.cumsum(n) - n), n)
        places += np.arange(len(places))
        return np.take(pool, places).tobytes()


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


class Packer:
    """Packs pieces (doc, start, ids as bytes, doc_tokens) into sequences."""

    def __init__(self, tiers=TIERS):
        self.tiers = sorted(tiers)
        if any(t & (t - 1) for t in self.tiers):
            raise ValueError("context sizes are powers of two")
        self.window = self.tiers[-1]
        self.by_length: dict[int, list] = {}
        self.lengths: list[int] = []
        self.waiting = 0

    def add(self, doc, ids: bytes) -> list:
        """Takes a document; returns its full windows, each a sequence."""
        n, view = len(ids) // 4, memoryview(ids)
        full = n // self.window * self.window
        out = [[(doc, at, view[4 * at:4 * (at + self.window)], n)] for at in range(0, full, self.window)]
        if full < n:
            self._put((doc, full, view[4 * full:], n))
        return out

    def _put(self, piece) -> None:
        n = len(piece[2]) // 4
        if n not in self.by_length:
            self.by_length[n] = []
            insort(self.lengths, n)
        self.by_length[n].append(piece)
        self.waiting += n

    def _take(self, most: int):
        """The longest waiting piece of at most ``most`` ids."""
        k = bisect_right(self.lengths, most) - 1
        if k < 0:
            return None
        n = self.lengths[k]
        rows = self.by_length[n]
        piece = rows.pop()
        if not rows:
            del self.by_length[n], self.lengths[k]
        self.waiting -= n
        return piece

    def _cut(self, piece, n: int):
        doc, start, ids, total = piece
        self._put((doc, start + n, ids[4 * n:], total))
        return doc, start, ids[:4 * n], total

    def _fill(self, tier: int) -> list:
        """One sequence of exactly ``tier`` ids; the caller knows that as many wait."""
        sequence, gap = [], tier
        while gap:
            piece = self._take(gap)          # the longest whole piece that fits
            if piece is None:                # none fits: cut a piece of a shorter tier, else any
                below = self._take(max(tier // 2, gap)) or self._take(self.window)
                piece = self._cut(below, gap)
            sequence.append(piece)
            gap -= len(piece[2]) // 4
        return sequence

    def drain(self, last: bool) -> list[list]:
        """Sequences of the waiting pieces, longest tier first."""
        out = []
        for tier, below in zip(reversed(self.tiers), [*reversed(self.tiers[:-1]), 0], strict=True):
            while self.waiting >= tier and (self.lengths[-1] > below):
                out.append(self._fill(tier))
            # too little is left to fill this tier: the pieces go on to the next shorter one
            while self.lengths and below and self.lengths[-1] > below:
                piece = self._take(self.window)
                out.append([self._cut(piece, below)])
        if last and self.waiting:
            rest = []
            while self.waiting:
                rest.append(self._take(self.window))
            out.append(rest)
        return out


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A group per sequence: full groups of one size first, then the rest together."""
    groups, used, current, at = {}, 0, {}, [0] * len(sizes)
    count = {}
    for s in sizes:
        count[s] = count.get(s, 0) + 1
    whole = {s: n // max(1, step_tokens // s) * max(1, step_tokens // s) for s, n in count.items()}
    seen: dict[int, int] = {}
    rest = []
    for i, s in enumerate(sizes):
        k = seen[s] = seen.get(s, 0) + 1
        if k > whole[s]:
            rest.append(i)
            continue
        slot = (s, (k - 1) // max(1, step_tokens // s))
        if slot not in groups:
            groups[slot], used = used, used + 1
        at[i] = groups[slot]
    filled = 0
    for i in sorted(rest, key=lambda i: -sizes[i]):
        if filled and filled + sizes[i] > step_tokens:
            used, filled = used + 1, 0
        at[i] = used
        filled += sizes[i]
    return at


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, end_id: int = END_ID) -> DataFrame:
    """The pieces: id, start, length, ids (little-endian 32 bit), doc_tokens,
    sequence_id, offset, tier (the sequence's size with padding) and step_group.
    """
    kind = docs.schema[id_col].dataType
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = word_ids(tokenizer_path), Packer(tiers)
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 33
        number = group = 0
        key_type = None

        def rows(sequences):
            nonlocal number, group
            if not sequences:
                return None
            sizes = [sum(len(p[2]) // 4 for p in s) for s in sequences]
            padded = [n if n & (n - 1) == 0 else packer.window for n in sizes]
            steps = step_groups(padded, step_tokens)
            cols = [[] for _ in range(9)]
            for s, size, step in zip(sequences, padded, steps, strict=True):
                offset = 0
                for doc, start, ids, total in s:
                    n = len(ids) // 4
                    for c, v in zip(cols, (doc, start, n, bytes(ids), total, first + number, offset, size,
                                           first + group + step), strict=True):
                        c.append(v)
                    offset += n
                number += 1
            group += max(steps) + 1
            types = [key_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=["__id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"])

        ready: list[list] = []
        ready_tokens = 0
        for part in C.text_slices(batches, 1, 4 * C.ROWS_AT_ONCE):
            key_type = part.schema.field(0).type
            keys = part.column(0).to_pylist()
            for k, (key, ids) in enumerate(zip(keys, encoder.encode(part.column(1)), strict=True), 1):
                full = packer.add(key, ids + end)
                ready += full
                ready_tokens += len(full) * packer.window
                if (k % C.ROWS_AT_ONCE == 0 or k == len(keys)) and packer.waiting + ready_tokens >= BUFFER_TOKENS:
                    yield rows(ready + packer.drain(False))
                    ready, ready_tokens = [], 0
        out = rows(ready + packer.drain(True))
        if out is not None:
            yield out

    source = docs.select(docs[id_col].alias("__id"), C.as_binary(text_col).alias("text"))
    return source.mapInArrow(C.tidy(run), C.fields(
        "__id", kind, "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
        "tier int, step_group long")).withColumnRenamed("__id", id_col)
