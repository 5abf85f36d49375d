"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a byte trie. Each node has a failure link and the number of pieces that leave when it is followed,
both computed once, so a word is counted in one pass over its bytes and no piece is ever built. The vocabulary's
single bytes are pieces too (byte fallback), so every word can be matched. A word ``[^\\x20\\x09-\\x0D]+`` is matched
with the word mark before it, case as it is.

Null and empty texts have no words and no tokens; very long ones are counted whole. Repeated rows are counted each;
other columns, whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm import text as T

MARK = "▁".encode()
#: Words whose counts a worker keeps; when full, it starts anew.
KNOWN = 400_000


class Automaton:
    def __init__(self, pieces: Iterable[bytes]):
        step: dict[int, int] = {}
        ends, parents = [False], []
        for piece in {*pieces, *(bytes([b]) for b in range(256))}:
            at = 0
            for b in piece:
                nxt = step.get(at << 8 | b)
                if nxt is None:
                    nxt = step[at << 8 | b] = len(ends)
                    ends.append(False)
                    parents.append((at, b))
                at = nxt
            ends[at] = True
        fail, popped = [0] * len(ends), [0] * len(ends)
        # Parents come before children by depth.
        depth = [0] * len(ends)
        for node, (up, _) in enumerate(parents, 1):
            depth[node] = depth[up] + 1
        for node in sorted(range(1, len(ends)), key=depth.__getitem__):
            up, b = parents[node - 1]
            if ends[node]:
                popped[node] = 1
                continue
            count, at = popped[up], fail[up]
            while at << 8 | b not in step:
                count += popped[at]
                at = fail[at]
            fail[node], popped[node] = step[at << 8 | b], count
        self.step, self.fail, self.popped = step, fail, popped

    def count(self, word: bytes) -> int:
        step, fail, popped = self.step, self.fail, self.popped
        at = total = 0
        for b in word:
            nxt = step.get(at << 8 | b)
            while nxt is None:
                total += popped[at]
                at = fail[at]
                nxt = step.get(at << 8 | b)
            at = nxt
        while at:
            total += popped[at]
            at = fail[at]
        return total


class Counts(dict):
    """Word to its number of pieces, computed when first asked."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.automaton.count(MARK + word)
        return n


def pieces_of(path: str) -> list[bytes]:
    """The pieces of a sentencepiece model that stand for text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i).encode() for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


@lru_cache(2)
def _counts(path: str) -> Counts:
    return Counts(Automaton(pieces_of(path)))


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _counts(path)
    for batch in T.chunks(batches):
        words, tokens, longest = [], [], []
        for text in T.texts_of(batch):
            own = text.split()  # ASCII white space only, as the word rule has it
            sizes = list(map(known.__getitem__, own))
            words.append(len(own))
            tokens.append(sum(sizes))
            longest.append(max(sizes, default=0))
            if len(known) > KNOWN:
                known.clear()
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(words, pa.int64()), "n_tokens": pa.array(tokens, pa.int64()), "longest_word": pa.array(longest, pa.int64())})


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_tokens, longest_word (most tokens of one word)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return T.binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(partial(_count, path), "doc_id long, n_words long, n_tokens long, longest_word long")
