"""Phrase collocations by sketch bounds and automata.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. Within a
language (null: ``und``) f(phrase) counts its contiguous occurrences within pieces, overlapping ones too, and n all
words. Phrases of 2 to ``longest`` words with a = f(phrase) >= ``least`` are candidates. Cut after its first k words, a
phrase scores floor(1000000 a a / (l r)) with l and r the f of both parts; its lowest cut counts, the smallest k of
equal ones. A candidate inside a longer one (itself kept or not) with 100 f(longer) >= ``inside`` a is dropped. The first
``top`` of each language remain, by score, a (both descending) and phrase (bytes ascending).

1. Shards. Normalised texts of one language are written once, in shards of some MB, which never change afterwards.
2. Sketch. A phrase of 1 to ``longest`` words falls into one of as many cells as the corpus has bytes (to a power of
   two), by hash of language and words. Shards send ranges of cells their distinct cells (Golomb-coded) and counts; a
   range adds them up and answers each shard which of its cells reach ``least``. A cell's sum bounds every phrase in it
   from above, so no candidate is lost; cells are spread over the ranges, so no task holds the sketch.
3. Automata. Each shard compiles its phrases whose cell, and whose parts' cells, reach ``least`` into automata, over an
   alphabet that spells each word with three signs of its places; pieces, and words of no candidate, are set apart by a
   delimiter that stands in no phrase, so that no match begins or ends within a word or runs across pieces. The automata count all overlapping
   matches in the shard. Counts are summed over the shards, within tasks first, then by range of cells, in which all of a
   phrase's counts meet; those below ``least`` go: what remains are exact counts of phrases, which are told apart by
   their words, not by hashes.
4. Scores come from joins of candidates with their parts, in decimals of 38 digits.

An automaton takes a bounded number of phrases, a shard a bounded number of bytes (a longer text is cut at a piece's
end; one without any is a shard by itself), so memory does not grow with the corpus. Null and empty texts have no words.
Repeated rows count each. Other columns, whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.llm import golomb
from framewell.llm import text as T
from framewell.llm.store import cut, partitions

#: Bytes of text in a shard, of all languages that a task holds back, of those whose phrases make one range of cells, and of
#: the shards that a task counts.
SHARD_BYTES, HELD_BYTES, RANGE_BYTES, TASK_BYTES = 4 << 20, 24 << 20, 8 << 20, 16 << 20
#: Phrases of one automaton.
AUTOMATON = 1 << 17
END = b"\n"
#: Lower-cases A-Z, ends of pieces become line feeds, tabs become spaces.
_NORMAL = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))

SHARDS = "shard long, lang string, data binary"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    name, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def flush(lang: str) -> pa.RecordBatch:
        nonlocal name
        data = press.compress(END.join(held.pop(lang)))
        del sizes[lang]
        name += 1
        return pa.record_batch({"shard": pa.array([name - 1]), "lang": pa.array([lang], pa.string()), "data": pa.array([data], pa.binary())})

    for batch in T.chunks(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), T.texts_of(batch)):
            text, at = text.translate(_NORMAL), 0
            while at < len(text):
                end = len(text) if len(text) - at <= SHARD_BYTES else text.find(END, at + SHARD_BYTES // 2)
                end = len(text) if end < 0 else end
                if lang in held and sizes[lang] + end - at > SHARD_BYTES:
                    yield flush(lang)
                held.setdefault(lang, []).append(text[at:end])
                sizes[lang] = sizes.get(lang, 0) + end - at
                at = end + 1
            if sum(sizes.values()) > HELD_BYTES:
                yield flush(max(sizes, key=sizes.get))
    for lang in list(held):
        yield flush(lang)


class Shard:
    """The words of a shard: number of each word, the distinct words, and the cells of its phrases by number of words."""

    def __init__(self, lang: str, data: bytes, longest: int, bits: int):
        import xxhash

        text = zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31)
        words = pa.array(filter(None, (END + text).replace(END, b" \n ").split(b" ")), pa.binary()).dictionary_encode()
        self.word, self.id = words.dictionary, words.indices.to_numpy()
        # The delimiter comes first, so its number is 0.
        self.n = int((self.id != 0).sum())
        seed = xxhash.xxh64_intdigest(lang.encode())
        hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.word.to_pylist()], np.uint64)
        inside, h = self.id != 0, hashes[self.id]
        self.cells, self.at, gram = [], [], h
        for k in range(1, longest + 1):
            if k > 1:
                gram = T.mix(gram[:-1] * T.U64(T.BASE) + h[k - 1 :])
                inside = inside[:-1] & (self.id[k - 1 :] != 0)
            at = np.flatnonzero(inside)
            self.at.append(at)
            self.cells.append(T.mix(gram[at] + T.U64(k)) >> T.U64(64 - bits))

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct cells, sorted, and how often each occurs."""
        cells = np.sort(np.concatenate(self.cells))
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(cells)), bool), cells[1:] != cells[:-1]]))
        return cells[first], np.diff(first, append=len(cells))


def _edges(cells: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    return np.searchsorted(cells, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(bits - (ranges.bit_length() - 1)))


def _send(longest: int, least: int, bits: int, ranges: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's distinct cells and counts (up to ``least``, beyond which all are alike) to each range."""
    press, width = zstandard.ZstdCompressor(level=1), 1 << (bits - (ranges.bit_length() - 1))
    for batch in batches:
        for name, lang, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "data"))):
            cells, count = Shard(lang, data, longest, bits).distinct()
            count = np.minimum(count, least).astype(np.uint8 if least < 128 else np.uint32)
            edge, rows = _edges(cells, bits, ranges), []
            for r in np.flatnonzero(np.diff(edge)).tolist():
                a, b = edge[r], edge[r + 1]
                rows.append((r, name, golomb.encode(cells[a:b], r * width, width), press.compress(count[a:b].tobytes())))
            for i in range(0, len(rows), 64):
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 64]), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["range", "shard", "cells", "counts"])


def _answer(least: int, bits: int, ranges: int, table: pa.Table) -> pa.Table:
    """Sum of each cell of a range; for each shard which of its cells reach ``least``."""
    r, width = table.column("range")[0].as_py(), 1 << (bits - (ranges.bit_length() - 1))
    kind = np.uint8 if least < 128 else np.uint32
    total = np.zeros(width, kind)
    plain, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    place = lambda cells: (golomb.decode(cells, r * width) - np.uint64(r * width)).astype(np.int64)
    for cells, counts in zip(table.column("cells"), table.column("counts")):
        at = place(cells.as_py())
        # The cells of one message are distinct; a sum stays at ``least`` once it is reached.
        total[at] = np.minimum(total[at] + np.frombuffer(plain.decompress(counts.as_py(), max_output_size=1 << 31), kind), least)
    told = [press.compress(np.packbits(total[place(cells.as_py())] >= least).tobytes()) for cells in table.column("cells")]
    return pa.table([table.column("shard"), pa.array([r] * len(told), pa.int32()), pa.array(told, pa.binary())], names=["shard", "range", "data"])


#: Digits of a word's number; each place has signs of its own, so that no match begins or ends within a word.
PLACES = 3


def _text_of(codes: np.ndarray, base: int) -> str:
    """PLACES signs for each number, the delimiter alone for 0: few signs, since a node's branches are searched in turn."""
    signs = [np.where(codes > 0, 1 + base * j + codes // base**j % base, 0) for j in range(PLACES)]
    return np.stack(signs, axis=-1).astype("<u4").tobytes().decode("utf-32-le")


def _matches(ids: np.ndarray, phrases: list[np.ndarray], words: int) -> list[np.ndarray]:
    """How often each phrase (rows of word numbers, one array for each length) occurs, by automata of bounded size."""
    import ahocorasick

    out = [np.zeros(len(p), np.int64) for p in phrases]
    flat = [(k, a) for k, p in enumerate(phrases) for a in range(0, len(p), AUTOMATON)]
    while flat:
        part, size = [], 0
        while flat and (not part or size + min(AUTOMATON, len(phrases[flat[0][0]]) - flat[0][1]) <= AUTOMATON):
            k, a = flat.pop(0)
            part.append((k, a, phrases[k][a : a + AUTOMATON]))
            size += len(part[-1][2])
        code = np.zeros(words, np.int64)
        used = np.unique(np.concatenate([p.reshape(-1) for _, _, p in part]))
        code[used] = np.arange(1, len(used) + 1)
        base = math.ceil((len(used) + 1) ** (1 / PLACES)) + 1
        automaton, number = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0
        for k, _, p in part:
            joined, width = _text_of(code[p.reshape(-1)], base), p.shape[1] * PLACES
            for i in range(len(p)):
                automaton.add_word(joined[i * width : i * width + width], number)
                number += 1
        automaton.make_automaton()
        found = np.bincount(np.fromiter((v for _, v in automaton.iter(_text_of(code[ids], base))), np.int64), minlength=number)
        at = 0
        for k, a, p in part:
            out[k][a : a + len(p)] = found[at : at + len(p)]
            at += len(p)
    return out


#: Phrases that a task holds before it sends their counts.
HELD_PHRASES = 3 << 18
COUNTS = "lang string, range int, data binary"


class _Sums:
    """Counts of a task's phrases. They are added up first and travel as sorted blocks, a block for each range of cells."""

    def __init__(self, shift: int):
        self.shift, self.parts, self.rows = shift, [], 0

    def add(self, lang: str, words: int, phrase: pa.Array, a: np.ndarray, cell: np.ndarray) -> None:
        self.parts.append(pa.table({"lang": pa.array([lang] * len(a), pa.string()), "words": pa.array(np.full(len(a), words, np.uint8)), "phrase": phrase.cast(pa.binary()), "a": pa.array(a), "range": pa.array((cell >> np.uint64(self.shift)).astype(np.int32))}))
        self.rows += len(a)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        table, self.parts, self.rows = pa.concat_tables(self.parts), [], 0
        # What is no longer needed goes before the next step.
        table = table.group_by(["lang", "range", "words", "phrase"]).aggregate([("a", "sum")])
        table = table.sort_by([("lang", "ascending"), ("range", "ascending"), ("phrase", "ascending")]).combine_chunks()
        lang, where = table.column("lang").combine_chunks().dictionary_encode(), table.column("range").to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], (np.diff(where) != 0) | (np.diff(lang.indices.to_numpy()) != 0)]))
        press, rows = zstandard.ZstdCompressor(level=3), []
        for i, j in zip(edge.tolist(), [*edge[1:].tolist(), table.num_rows]):
            part = table.slice(i, j - i)
            phrases = part.column("phrase").combine_chunks()
            size = pc.binary_length(phrases).to_numpy()
            data = T.pack(part.column("words").to_numpy(), _small(size), _small(part.column("a_sum").to_numpy())) + b"".join(phrases.to_pylist())
            rows.append((lang[i].as_py(), int(where[i]), press.compress(data)))
        for i in range(0, len(rows), 64):
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 64]), (pa.string(), pa.int32(), pa.binary()))], names=["lang", "range", "data"])


def _small(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _total(least: int, table: pa.Table) -> pa.Table:
    """The counts of a language's range, added up; of phrases below ``least`` none."""
    plain, parts = zstandard.ZstdDecompressor(), []
    for data in table.column("data").to_pylist():
        data = plain.decompress(data, max_output_size=1 << 31)
        words, size, a = T.unpack(data)
        at = len(data) - int(size.sum())
        offsets = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
        parts.append(pa.table({"words": pa.array(words.astype(np.int32)), "phrase": pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data[at:])]), "a": pa.array(a.astype(np.int64))}))
    out = pa.concat_tables(parts).group_by(["words", "phrase"]).aggregate([("a", "sum")]).rename_columns(["words", "phrase", "a"])
    out = out.filter(pc.or_(pc.equal(out.column("words"), 0), pc.greater_equal(out.column("a"), least)))
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * out.num_rows, pa.string()), "words": out.column("words"), "phrase": out.column("phrase").cast(pa.large_string()).cast(pa.string()), "a": out.column("a")})


def _scan(longest: int, bits: int, lead: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each shard (no phrase, 0 words) and the occurrences of its phrases whose bounds reach ``least``."""
    plain, sums = zstandard.ZstdDecompressor(), _Sums(bits - lead)
    for batch in batches:
        for lang, data, answers in zip(*(batch.column(c).to_pylist() for c in ("lang", "data", "answers"))):
            shard = Shard(lang, data, longest, bits)
            sums.add(lang, 0, pa.array([""], pa.string()), np.array([shard.n]), np.zeros(1, np.uint64))
            if not answers:
                continue
            cells, _ = shard.distinct()
            bitmaps = [np.unpackbits(np.frombuffer(plain.decompress(x["data"], max_output_size=1 << 31), np.uint8)) for x in sorted(answers, key=lambda x: x["range"])]
            # Bitmaps are whole bytes; each message's size is that of its range here.
            edge = np.flatnonzero(np.concatenate([[True], np.diff((cells >> np.uint64(bits - lead)).astype(np.int64)) != 0]))
            sizes = np.diff(edge, append=len(cells))
            high = cells[np.concatenate([b[:n] for b, n in zip(bitmaps, sizes)]).astype(bool)]
            # A small table first, since few cells are high.
            maybe = np.zeros(1 << 22, bool)
            maybe[(high & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            reach, phrases, where = np.zeros(len(shard.id), bool), [], []
            for k, (own, at) in enumerate(zip(shard.cells, shard.at), 1):
                some = maybe[(own & np.uint64((1 << 22) - 1)).astype(np.int64)]
                if k > 1:  # both parts of one word less
                    some &= reach[at] & reach[at + 1]
                own, at = own[some], at[some]
                sure = high[np.minimum(np.searchsorted(high, own), max(len(high) - 1, 0))] == own if len(high) else np.zeros(len(own), bool)
                own, at = own[sure], at[sure]
                reach = np.zeros(len(shard.id) + 1, bool)
                reach[at] = True
                # Phrases of k words by the number of the first k - 1 and the last word.
                ids = shard.id[at].astype(np.int64)
                for j in range(1, k):
                    _, ids = np.unique(ids * len(shard.word) + shard.id[at + j], return_inverse=True)
                _, first = np.unique(ids, return_index=True)
                phrases.append(shard.id[at[first][:, None] + np.arange(k)])
                where.append(own[first])
            for k, (own, cell, found) in enumerate(zip(phrases, where, _matches(shard.id, phrases, len(shard.word))), 1):
                if len(own):
                    names = [shard.word.take(pa.array(own[:, j])).cast(pa.string()) for j in range(k)]
                    sums.add(lang, k, pc.binary_join_element_wise(*names, " ") if k > 1 else names[0], found, cell)
            del shard, phrases, where, found
            if sums.rows > HELD_PHRASES:
                yield from sums.blocks()
    if sums.rows:
        yield from sums.blocks()
    T.trim()


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """lang, words, phrase and a of every phrase of 1 to ``longest`` words with a >= ``least``; the row of 0 words holds a lang's number of words."""
    spark = docs.sparkSession
    source = T.binary_text(docs, F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    shards = cut(source.mapInArrow(_shards, SHARDS))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Powers of two: a range is a number of leading bits of a cell.
    lead = max(1, math.ceil(math.log2(max(partitions(spark), size / RANGE_BYTES))))
    ranges, bits = 1 << lead, max(16, lead, size.bit_length())

    def answer(table: pa.Table) -> pa.Table:
        return _answer(least, bits, ranges, table)

    sent = shards.mapInArrow(partial(_send, longest, least, bits, ranges), "range int, shard long, cells binary, counts binary")
    told = sent.groupBy("range").applyInArrow(answer, "shard long, range int, data binary")
    told = told.groupBy("shard").agg(F.collect_list(F.struct("range", "data")).alias("answers"))

    def total(table: pa.Table) -> pa.Table:
        return _total(least, table)

    # Counting is much work for few bytes, so tasks are not merged by their bytes.
    tasks = max(partitions(spark), math.ceil(size / TASK_BYTES))
    found = shards.repartition(tasks, "shard").join(told.repartition(tasks, "shard").hint("shuffle_hash"), "shard", "left").mapInArrow(partial(_scan, longest, bits, lead), COUNTS)
    return found.groupBy("lang", "range").applyInArrow(total, "lang string, words int, phrase string, a long")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score. docs needs lang and text."""
    counts = cut(phrase_counts(docs, longest, least))
    word = lambda a, b: F.array_join(F.slice("w", a, b), " ")
    phrases = counts.where("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", word(F.lit(1), F.col("k")).alias("left"), word(F.col("k") + 1, F.size("w")).alias("right"))
    part = lambda side, name: counts.where("words > 0").select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    exact = lambda c: f"CAST({c} AS decimal(15, 0))"
    cuts = cuts.withColumn("score", F.expr(f"(CAST(1000000 AS decimal(7, 0)) * {exact('a')} * {exact('a')}) div ({exact('l')} * {exact('r')})"))
    best = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.expr("flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), i -> array_join(slice(w, i, k), ' '))))")
    longer = phrases.where("words > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    best = best.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = counts.where("words = 0").select("lang", F.col("a").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
