"""Large JSON files in blocks against whole-file parsing."""

import json
import random

import pytest
from pyspark.sql import functions as F

from framewell.sources import bigjson as B
from framewell.sources import files as S


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice([1, -2.5, True, None, ""])
    if kind < 4:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "a", "é", "漢", "\n", " ", '"}', '\\"}', '}"', "}}"]) for _ in range(rng.randrange(12)))
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}" + value(rng, 3).__str__(): value(rng, depth + 1) for i in range(rng.randrange(4))}


def blocks(spark, size):
    for k, v in (("maxPartitionBytes", size), ("openCostInBytes", 1), ("minPartitionNum", 1)):
        spark.conf.set(f"spark.sql.files.{k}", str(v))


@pytest.fixture
def small_blocks(spark):
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    yield lambda size: blocks(spark, size)
    for k, v in kept.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)


@pytest.mark.parametrize(("size", "held"), [(150, 8 << 20), (400, 8 << 20), (211, 20), (1 << 27, 64)])
def test_blocks_equal_whole_file_parsing(spark, tmp_path, small_blocks, monkeypatch, size, held):
    """Objects and lists of random values, among them strings of quotes, braces and backslashes, over many small blocks."""
    monkeypatch.setattr(B, "HELD", held)
    small_blocks(size)
    rng = random.Random(size)
    want = {}
    for f in range(4):
        own = {f'id{i} "{{\\': {"a": value(rng), "b": {"c": [value(rng), value(rng)]}, "d": "x" * rng.choice([0, 3, 500])} for i in range(30)}
        text = json.dumps(own, ensure_ascii=bool(f % 2), indent=f if f > 1 else None) + "\n" * (f % 3)
        (tmp_path / f"part_{f}.json").write_text(text)
        want[f] = [(k, v) for k, v in own.items()]
    listed = [{"id": f"n{i}", "v": value(rng)} for i in range(25)] + [{"v": "no id"}]
    (tmp_path / "part_9.json").write_text("  \n" + json.dumps(listed))
    want[9] = [(x["id"], x) for x in listed if "id" in x]
    got = B.keyed(B.json_members(spark, f"file://{tmp_path}", strict=True), "id")
    rows = got.select("id", "record", F.regexp_extract("path", r"part_(\d)", 1).cast("int").alias("f"), "block", "seq").collect()
    for f, own in want.items():
        assert [(r.id, json.loads(r.record)) for r in sorted((r for r in rows if r.f == f), key=lambda r: (r.block, r.seq))] == own
    if size < 1000:
        assert len({(r.f, r.block) for r in rows}) > 20


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "one.json").write_text(json.dumps({str(i): {"v": i, "t": "}" * (i % 5)} for i in range(2000)}))
    small_blocks(2000)
    scan = B._blocks(spark, f"file://{tmp_path}", 1, 0)
    assert scan.rdd.getNumPartitions() > 10
    got = {r.id: json.loads(r.record)["v"] for r in S.keyed_records(spark, f"file://{tmp_path}", "id").collect()}
    assert got == {str(i): i for i in range(2000)}


def test_passes_over_files(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(B, "MOST_BLOCKS", 7)
    small_blocks(100)
    for f in range(5):
        (tmp_path / f"{f}.json").write_text(json.dumps({f"{f}-{i}": {"v": [i, "{"]} for i in range(20)}))
    assert {r.id for r in S.keyed_records(spark, f"file://{tmp_path}", "id").collect()} == {f"{f}-{i}" for f in range(5) for i in range(20)}


def test_odd_files(spark, tmp_path, small_blocks):
    """Empty files, empty objects, scalars, a byte order mark, unfinished files, repeated keys, wanted ids."""
    small_blocks(16)
    texts = {"a": "", "b": "{}", "c": " [ ] \n", "d": '"text, {"', "e": "\ufeff{\"bom\": 1}", "f": '{"one": {"v": 1}, "two": {"v": 2', "g": '{"three": 3, "four": 4', "h": '{"twice": {"v": 1}, "x": "}", "twice": {"v": 2}}', "i": '{"twice": {"v": 3}}'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    path = f"file://{tmp_path}"
    got = {r.id: r.record for r in S.keyed_records(spark, path, "id").collect()}
    assert got == {"bom": "1", "one": '{"v": 1}', "three": "3", "x": '"}"', "twice": '{"v": 3}'}
    wanted = spark.createDataFrame([("x",), ("none",)], "id string")
    assert [r.id for r in S.keyed_records(spark, path, "id", wanted).collect()] == ["x"]
    for name in ("a", "b", "c", "h"):
        B.json_members(spark, f"{path}/{name}.json", strict=True).count()
    for name in ("d", "f", "g"):
        with pytest.raises(Exception, match="not one whole JSON"):
            B.json_members(spark, f"{path}/{name}.json", strict=True).count()


def test_written_objects_are_json(spark, tmp_path):
    rows = spark.createDataFrame([(i, json.dumps({"v": "}" * i})) for i in range(40)] + [(None, "{}"), (41, None)], "id int, record string")
    B.write_keyed(rows.repartition(3), "id", "record", f"file://{tmp_path}/out")
    texts = [f.read_text() for f in (tmp_path / "out").glob("part-*")]
    assert {k: v for t in texts for k, v in json.loads(t).items()} == {str(i): {"v": "}" * i} for i in range(40)}
    assert {r.id for r in S.keyed_records(spark, f"file://{tmp_path}/out", "id").collect()} == {str(i) for i in range(40)}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_members_are_cut_in_one_pass(spark, tmp_path, small_blocks, monkeypatch):
    """Pieces are read for only if a file has several blocks or a member may be held for long, and the two passes agree on places."""
    (tmp_path / "a.json").write_text(json.dumps({"x": {"v": "}, {"}, "y": [], "z": {}}, indent=1))
    (tmp_path / "b.json").write_text("{ }")
    path, whole = f"file://{tmp_path}", [("a", '"x": {"v": "}, {"}'), ("a", '"y": []'), ("a", '"z": {}')]

    def got():
        rows = B.json_members(spark, path, strict=True)
        found = sorted(rows.collect(), key=lambda r: (r.path, r.block, r.seq))
        assert [(r.path[-6], " ".join(r.member.replace("\n", " ").split()).replace("{ ", "{").replace('" }', '"}').replace("{ }", "{}")) for r in found] == whole
        return _plan(rows).count("MapInArrow")

    assert got() == 1
    monkeypatch.setattr(B, "HELD", 4)
    assert got() == 2
    monkeypatch.setattr(B, "HELD", 8 << 20)
    small_blocks(8)
    assert got() == 2


def test_blocks_begin_where_those_before_end(spark):
    """Without a call of Python for each file."""
    rows = [("a", 0, 1, 2, -1, "{", 10, 40), ("a", 10, 1, 5, 0, '"', 10, 40), ("a", 20, 0, -2, 7, "x", 20, 40), ("b", 0, 0, 0, 0, "[", 9, 8), ("c", 0, 0, 0, 0, "1", 2, 2)]
    states = B._states(spark.createDataFrame(rows, B.BLOCKS), False)
    assert "Pandas" not in _plan(states)
    assert {tuple(r) for r in states.collect()} == {("a", 0, 0, 0, "{", False, True), ("a", 10, 1, 2, "{", False, True), ("a", 20, 0, 2, "{", False, True), ("b", 0, 0, 0, "[", True, False), ("c", 0, 0, 0, "1", False, False)}


def test_snapshots_take_a_record_apart_once(spark):
    texts = {"x": None, "12": 12.0, " 7 ": 7.0, "1e3": 1000.0, "-inf": float("-inf"), "Infinity": float("inf"), "": None, "none": None, "0x": None}
    records = [(k, json.dumps({"snapshot_0": {"viewCount": k, "likeCount": 5}, "snapshot_1": None})) for k in texts]
    records += [("listed", json.dumps({"snapshots": [{"viewCount": 1}, {"viewCount": "2"}], "snapshot_0": {"viewCount": 9}})), ("none at all", "{}"), ("a list", "[1]")]
    rows = S.snapshots(spark.createDataFrame(records, "id string, record string"), "id", [0, 1])
    assert "get_json_object" not in _plan(rows)
    assert {(r.id, r.snapshot_index): r.views for r in rows.collect()} == {**{(k, 0): v for k, v in texts.items()}, ("listed", 0): 1.0, ("listed", 1): 2.0}
