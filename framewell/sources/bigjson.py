"""Large JSON files, an object or a list each, read by many tasks (S07, S08 of the survey).

Spark's text source splits a file at closing braces, which say nothing about where in the document one is: a brace may
stand in a string, at any depth. So blocks are read twice, and nothing of a file is ever held whole:

1. each block is scanned for both cases, beginning in a string or not: whether it ends in one, and by how much the depth
   changes. A block is one row then, and the rows of a file, in order, tell where each block really begins;
2. each block is cut at the commas of depth one, many members in one step. Members that lie in one block are done; those
   that a block's end cuts are put together from their pieces, few for each block, which are read apart from the rest and
   only if a file has more than one block or a long one.

Escapes never cross a block's end, since that follows a brace.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Blocks whose beginnings are broadcast at once; more are read in passes over the files.
MOST_BLOCKS = 100_000
#: Bytes of a block that a task looks at at once, or a row of it if that is longer.
SLICE = 1 << 20
#: Characters of an unfinished member that a task holds before it gives a piece of it.
HELD = 8 << 20

_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("{"), ord("[")]], _DEPTH[[ord("}"), ord("]")]] = 1, -1
_MARK = _DEPTH != 0
_MARK[ord(",")] = True


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets and commas, the number of quotes before each (modulo 2), and all quotes that are not escaped."""
    b = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(b == 34)
    slashes = np.flatnonzero(b == 92)
    if len(slashes) and len(quotes):
        # Backslashes right before a quote: its distance from where their run begins.
        begins = np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) > 1, slashes, 0))
        last = np.searchsorted(slashes, quotes) - 1
        touched = (last >= 0) & (slashes[last] == quotes - 1)
        quotes = quotes[~touched | ((quotes - begins[last]) % 2 == 0)]
    at = np.flatnonzero(_MARK[b])
    return at, np.searchsorted(quotes, at) & 1, quotes


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes, dict]]:
    """Text of one block, in slices of whole rows, with the row's other columns."""
    for batch in batches:
        rows = batch.num_rows
        value = batch.column("value")
        block, size = batch.column("block").to_numpy(), np.cumsum(pc.binary_length(value).to_numpy(zero_copy_only=False))
        path = batch.column("path").dictionary_encode()
        name, names = path.indices.to_numpy(), path.dictionary.to_pylist()
        new = np.flatnonzero((np.diff(block) != 0) | (np.diff(name) != 0)) + 1
        for at, end in zip([0, *new.tolist()], [*new.tolist(), rows]):
            more = {c: batch.column(c)[at].as_py() for c in batch.schema.names if c not in ("path", "block", "value")} if at < end else {}
            while at < end:
                stop = int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, "right"))
                stop = min(end, max(at + 1, stop))
                text = pc.binary_join_element_wise(value.slice(at, stop - at), "}", "").buffers()[2]
                yield names[name[at]], int(block[at]), text[: int(size[stop - 1] - (size[at - 1] if at else 0)) + stop - at].to_pybytes(), more
                at = stop


BLOCKS = "path string, block long, flips int, plain long, quoted long, shape string, bytes long, size long"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block: whether its quotes flip the state, the change of depth if it begins outside or inside a string, and its first sign."""
    held: dict[tuple[str, int], list] = {}
    for path, block, text, more in _runs(batches):
        flips, plain, quoted, shape, size, _ = held.setdefault((path, block), [0, 0, 0, "", 0, 0])
        at, odd, quotes = _marks(text)
        step = _DEPTH[np.frombuffer(text, np.uint8)[at]].astype(np.int64)
        even, other = int(step[odd == 0].sum()), int(step[odd == 1].sum())
        if flips:
            even, other = other, even
        lead = shape or text.lstrip(b"\xef\xbb\xbf \t\r\n")[:1].decode(errors="replace")
        held[(path, block)] = [flips ^ (len(quotes) & 1), plain + even, quoted + other, lead, size + len(text), more["size"]]
    rows = [(p, b, *x) for (p, b), x in held.items()]
    if rows:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=[x.split()[0] for x in BLOCKS.split(", ")])


def _states(rows: DataFrame, strict: bool) -> DataFrame:
    """Where each block of a file begins, from the summaries of those before it, and whether a block's end may cut members of the file."""
    whole = Window.partitionBy("path")
    by_place = whole.orderBy("block")
    before = by_place.rowsBetween(Window.unboundedPreceding, -1)
    first = by_place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("inside", (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).cast("int"))
    rows = rows.withColumn("change", F.when(F.col("inside") == 1, F.col("quoted")).otherwise(F.col("plain")))
    # The brace after the last row is none of the file's if there are more bytes than the file has. A member that only it ends is unfinished.
    added, end, shape = F.sum("bytes").over(whole) > F.first("size").over(first), F.sum("change").over(whole), F.first("shape").over(first)
    path = F.col("path")
    if strict:
        broken = (F.sum("flips").over(whole) % 2 == 1) | (end + added.cast("int") > 0) | ~shape.isin("{", "[")
        path = F.when(broken, F.raise_error(F.concat(F.lit("not one whole JSON object or list: "), path))).otherwise(path).alias("path")
    depth = F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth")
    several = ((F.count("*").over(whole) > 1) | (F.sum("bytes").over(whole) > HELD)).alias("several")
    return rows.select(path, "block", "inside", depth, shape.alias("shape"), (added & (end == 0)).alias("unfinished"), several)


WHOLE, HEAD, MIDDLE, TAIL = range(4)
PIECES = "path string, shape string, unfinished boolean, block long, seq long, kind int, text string"


def _between(text: bytes, cuts: np.ndarray) -> pa.Array:
    """What lies between each cut and the next, as binary."""
    parts = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts + 1).astype(np.int32)), pa.py_buffer(text)])
    return pc.binary_slice(parts, 0, -1)


def _members(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Of a block's members the whole ones, or the pieces of those that a block's end cuts or that are long."""
    state: dict = {}
    out: list[pa.RecordBatch] = []
    kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.string())

    def put(kind: int, text: pa.Array, seq: np.ndarray) -> None:
        if len(text):
            same = [pa.repeat(pa.scalar(x, k), len(text)) for x, k in zip((*state["key"], kind), (*kinds[:4], kinds[5]))]
            out.append(pa.record_batch([*same[:4], pa.array(seq), same[4], text.cast(pa.string())], names=[x.split()[0] for x in PIECES.split(", ")]))

    def members(text: pa.Array, wanted: np.ndarray | None = None) -> None:
        seq = np.arange(state["seq"], state["seq"] + len(text))
        state["seq"] += len(text)
        if whole:
            own = pc.not_equal(pc.binary_length(pc.ascii_trim_whitespace(text.cast(pa.string()))), 0).to_numpy(zero_copy_only=False)
            own = own if wanted is None else own & wanted
            put(WHOLE, text if own.all() else text.filter(pa.array(own)), seq[own])

    def give(kind: int, text: bytes) -> None:
        if kind == WHOLE:
            members(pa.array([text], pa.binary()))
            return
        if not whole:
            put(kind, pa.array([text], pa.binary()), np.array([state["seq"]]))
        state["seq"] += 1

    def close() -> None:
        """What is left at a block's end is a piece."""
        if state and state["open"] is not None and (state["held"] or state["open"] == HEAD):
            give(state["open"], b"".join(state["held"]))

    def table() -> list[pa.RecordBatch]:
        batches = pa.Table.from_batches(out).combine_chunks().to_batches()
        out.clear()
        return batches

    for path, block, text, more in _runs(batches):
        if state.get("key") != (path, more["shape"], more["unfinished"], block):
            close()
            state = {"key": (path, more["shape"], more["unfinished"], block), "seq": 0, "inside": more["inside"], "depth": more["depth"], "held": [], "open": MIDDLE if more["depth"] > 0 else None}
        at, odd, quotes = _marks(text)
        at = at[odd == state["inside"]]
        step = _DEPTH[np.frombuffer(text, np.uint8)[at]].astype(np.int64)
        after = state["depth"] + np.cumsum(step)
        before = after - step
        # The document's own brackets, and the commas of depth one.
        cuts = np.flatnonzero(((step == 1) & (before == 0)) | ((step == -1) & (before == 1)) | ((step == 0) & (before == 1)))
        start = 0
        if len(cuts):
            places, ends = at[cuts], step[cuts] == -1
            if state["open"] is not None:
                give({HEAD: WHOLE, MIDDLE: TAIL}[state["open"]], b"".join([*state["held"], text[: places[0]]]))
            if len(cuts) > 1:
                members(_between(text, places), ~ends[:-1])
            state["held"], start = [], int(places[-1]) + 1
            state["open"] = None if ends[-1] else HEAD
        if state["open"] is not None:
            state["held"].append(text[start:])
            if sum(map(len, state["held"])) > HELD:
                give(state["open"], b"".join(state["held"]))
                state["held"], state["open"] = [], MIDDLE
        state["inside"] ^= len(quotes) & 1
        state["depth"] = int(after[-1]) if len(after) else state["depth"]
        if sum(x.num_rows for x in out) > 4096 or sum(x.nbytes for x in out) > HELD:
            yield from table()
    close()
    if out:
        yield from table()


def _share(rows: DataFrame, passes: int, number: int) -> DataFrame:
    return rows.where(F.pmod(F.hash("path"), F.lit(passes)) == number) if passes > 1 else rows


def _blocks(spark: SparkSession, path: str, passes: int, number: int) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(path)
    rows = rows.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"))
    return _share(rows, passes, number)


def _glued(pieces: DataFrame) -> DataFrame:
    """Members put together from their pieces."""
    place = Window.partitionBy("path").orderBy("block", "seq")
    cut_up = pieces.withColumn("n", F.sum((F.col("kind") == HEAD).cast("int")).over(place)).where("n > 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))), lambda x: x["text"]), "")
    glued = cut_up.groupBy("path", "shape", "unfinished", "n").agg(F.min(F.struct("block", "seq")).alias("at"), F.max("kind").alias("end"), text.alias("member"))
    return glued.where((F.col("end") == TAIL) & (F.trim("member") != "")).select("path", "shape", "unfinished", "at.block", "at.seq", "member")


def json_members(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """The members of every file below path: path, shape ('{' or '['), block and seq (their order in a file), member.

    A member of an object is its text with the key, ``"key": value``; one of a list its value's text. Files that are
    neither give nothing, an unfinished last member is dropped; with ``strict`` both are errors.
    """
    from framewell.sources.files import cut

    rows = _blocks(spark, path, 1, 0)  # once, as it lists the files
    begins = cut(_states(rows.mapInArrow(_summaries, BLOCKS), strict))
    seen = begins.agg(F.count("*").alias("n"), F.max("unfinished").alias("torn"), F.max("several").alias("several")).first()
    passes = -(-seen.n // MOST_BLOCKS) or 1

    def members(whole: bool, of: str) -> DataFrame:
        parts = []
        for number in range(passes):
            # Broadcast, so that the rows of a block stay in order.
            where = F.broadcast(_share(begins, passes, number).where("shape IN ('{', '[')").where(of).drop("several"))
            parts.append(_share(rows, passes, number).drop("size").join(where, ["path", "block"]).mapInArrow(partial(_members, whole=whole), PIECES))
        return reduce(DataFrame.union, parts)

    out = members(True, "true").select("path", "shape", "unfinished", "block", "seq", F.col("text").alias("member"))
    if seen.several:
        out = out.union(_glued(members(False, "several")))
    if seen.torn:
        last = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("block"), F.desc("seq"))) == 1
        out = out.where("NOT unfinished").union(out.where("unfinished").withColumn("last", last).where("NOT last").drop("last"))
    return out.drop("unfinished")


def keyed(members: DataFrame, key: str) -> DataFrame:
    """Members with their keys, and the rest of each, unparsed, as ``record``; list members have the key as a field."""
    name = r'(?s)^\s*("[^"\\]*(?:\\.[^"\\]*)*")\s*:\s*'
    split = members.withColumns({"_head": F.regexp_extract("member", name, 0), "_name": F.regexp_extract("member", name, 1)})
    # Most keys stand there as they are; those with escapes are parsed.
    bare = F.substr("_name", F.lit(2), F.length("_name") - 2)
    quoted = F.when(F.col("_name").rlike(r'^"[^\\\x00-\x1F]*"$'), bare).otherwise(F.from_json(F.concat(F.lit("["), "_name", F.lit("]")), "array<string>")[0])
    own = F.when(F.col("shape") == "{", quoted).otherwise(F.get_json_object("member", f"$.{key}"))
    record = F.when(F.col("shape") == "{", F.substr("member", F.length("_head") + 1)).otherwise(F.col("member"))
    return split.select(own.alias(key), F.rtrim(record).alias("record"), "path", "block", "seq").where(F.col(key).isNotNull())


def write_keyed(df: DataFrame, key: str, value: str, path: str) -> None:
    """One JSON object a partition, ``{key: value, ...}``; value is JSON text. Written as it streams, nothing is gathered.

    Rows without key or value are left out.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "{"
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for member in batch.column("member").slice(at, 256).to_pylist():
                    out.append(mark + member)
                    mark = ","
                yield pa.record_batch({"value": pa.array(out, pa.string())})
        yield pa.record_batch({"value": pa.array(["}" if mark == "," else "{}"], pa.string())})

    name = F.regexp_replace(F.to_json(F.array(F.col(key).cast("string"))), r"(?s)^\[(.*)\]$", "$1")
    rows = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    rows.select(F.concat(name, F.lit(":"), F.col(value)).alias("member")).mapInArrow(lines, "value string").write.text(path)
