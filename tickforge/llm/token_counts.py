"""Token counts by trie-shared dynamic programming (operator 10).

A text's pre-tokens are its white-space separated words, each with the word
mark in front.  A pre-token's tokens are the pieces of its best segmentation
under a unigram model: the sum of the pieces' scores is greatest, then the
number of pieces smallest.  Scores come from the ranks of a public
vocabulary by Zipf's law, in whole micro-nats so that sums are exact.  A
character that is no piece costs one token per UTF-8 byte.

The distinct pre-tokens of an Arrow batch are walked in sorted order, which
is a depth-first walk of their trie: the forward scores of a shared prefix
stay on the stack and only the part below the branch is computed.  The count
at a terminal is remembered per worker and looked up for each occurrence.

Null or empty texts have no pre-tokens and count 0.  A null id stays null.
Repeated rows are counted each by itself; columns other than the id and the
text are not read, so clashing names do not matter; an empty table gives an
empty result.  Very long texts and words are handled whole; a word over
``LONG_WORD`` characters is not remembered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

MARK = "▁"
LONG_WORD = 4096
KNOWN_WORDS = 400_000       # counts remembered by a worker
ZIPF_SHIFT = 2.7            # Zipf-Mandelbrot shift of the rank
BYTE_PENALTY = 4_000_000    # micro-nats below the rarest piece, for each fallback byte


def unigram_scores(model_path: str) -> dict[str, int]:
    """piece -> score in micro-nats, by rank; control and byte pieces are left out."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    norm = math.log(sum(1 / (r + ZIPF_SHIFT) for r in range(1, len(pieces) + 1)))
    return {p: round(-1e6 * (math.log(r + ZIPF_SHIFT) + norm)) for r, p in enumerate(pieces, 1)}


class TrieCounter:
    """Terminal token counts of pre-tokens, forward scores shared by prefix."""

    def __init__(self, scores: dict[str, int]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0) - BYTE_PENALTY
        # Every ending of a piece: its score, or 0 where the ending is no piece.
        # Scores are negative.  A run that ends no piece ends the search to the left.
        self.endings = {p[i:]: 0 for p in scores for i in range(len(p))} | scores

    def counts(self, words) -> dict[str, int]:
        ending, byte = self.endings.get, self.byte
        out: dict[str, int] = {}
        best, tokens, last = [0], [0], ""   # by prefix length of the current branch
        for word in sorted(words):
            keep, most = 0, min(len(word), len(last))
            if word[:most] == last[:most]:
                keep = most
            else:
                while word[keep] == last[keep]:
                    keep += 1
            del best[keep + 1:], tokens[keep + 1:]
            for end in range(keep + 1, len(word) + 1):
                start = end - 1
                s = ending(word[start:end])
                if s:
                    top, n = s + best[start], tokens[start] + 1
                else:
                    size = len(word[start].encode("utf-8", "surrogatepass"))
                    top, n = best[start] + size * byte, tokens[start] + size
                while s is not None and start:
                    start -= 1
                    s = ending(word[start:end])
                    if s:
                        total = s + best[start]
                        if total > top or total == top and tokens[start] + 1 < n:
                            top, n = total, tokens[start] + 1
                best.append(top)
                tokens.append(n)
            out[word] = tokens[-1]
            last = word
        return out


_LOADED: dict[str, tuple[TrieCounter, dict[bytes, int]]] = {}


def _loaded(path: str) -> tuple[TrieCounter, dict[bytes, int]]:
    if path not in _LOADED:
        _LOADED[path] = TrieCounter(unigram_scores(path)), {}
    return _LOADED[path]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_pretokens and n_tokens of every row of ``docs``.

    ``model_path`` names the vocabulary file, which every executor must have
    (it is installed with the tokenizers, not shipped).
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = _loaded(model_path)
        for batch in C.slices(batches):
            split = [t.split() for t in batch.column(1).to_pylist()]
            if len(known) > KNOWN_WORDS:
                known.clear()
            new = {w for words in split for w in words if w not in known}
            by_text = {(MARK + w.decode("utf-8", "replace")): w for w in new}
            fresh = counter.counts(by_text)
            now = known
            if any(len(w) > LONG_WORD for w in new):
                now = dict(known)
            now.update((by_text[t], n) for t, n in fresh.items())
            if len(by_text) < len(new):  # different invalid bytes that read as the same text
                now.update((w, fresh[MARK + w.decode("utf-8", "replace")]) for w in new)
            if now is not known:
                known.update((w, now[w]) for w in new if len(w) <= LONG_WORD)
            get = now.__getitem__
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in split], pa.int64()),
                 pa.array([sum(map(get, w)) for w in split], pa.int64())], names=[id_col, "n_pretokens", "n_tokens"])

    source = docs.select(docs[id_col], C.as_binary(text_col).alias("text"))
    return source.mapInArrow(C.tidy(count), C.fields(id_col, docs.schema[id_col].dataType, "n_pretokens long, n_tokens long"))
