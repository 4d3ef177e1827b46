"""The split-parallel snapshot read against Spark's one-task read."""

import bz2
import random
from collections import Counter

import pytest

from caselake.sources import csv_splits
from caselake.sources.snapshots import CORRUPT, scan_snapshot_csv, snapshot_schema

HEADER = ["id", "type", "plain_text", "notes"]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "96", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def one_task(spark, path):
    df = (spark.read.schema(snapshot_schema(HEADER)).option("header", True).option("multiLine", True).option("escape", '"')
          .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return Counter(tuple(r)[:-1] for r in df.collect() if r[-1] is None)


def in_splits(spark, path):
    return Counter(tuple(r) for r in scan_snapshot_csv(spark, path, HEADER).collect())


def field(rng):
    kind = rng.random()
    if kind < 0.25:
        return rng.choice(["", "plain", "é漢", 'in"side', "a b", "x" * rng.randrange(80)])
    inner = "".join(rng.choices(["word ", "\n", '""', ",", "\n\n", '"",""', "é", "1,2\n3", "\t"], k=rng.choice([0, 1, 3, 30])))
    return f'"{inner}"'


def record(rng):
    if rng.random() < 0.12:  # malformed: wrong number of fields, junk after a closing quote
        return rng.choice(["only", "a,b", '"a"b,c,d,e', '"x"junk "more",2,3,4', 'a"b","c\nd",e,f', '1,"2"" ,3",4,5', '"",""', ',,,', '"a" ,"b",c,d'])
    return ",".join(field(rng) for _ in HEADER)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_one_task_read(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    for n in range(3):
        body = end.join([",".join(HEADER), *(record(rng) for _ in range((60, rng.choice([0, 1]), 30)[n]))])
        (tmp_path / f"part{n}.csv").write_text(body + rng.choice(["", end]), newline="")
    small_splits(rng.choice([40, 96, 500]))
    assert csv_splits.read_lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 6
    assert in_splits(spark, str(tmp_path)) == one_task(spark, str(tmp_path))


def test_bz2_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    rng = random.Random(9)
    rows = [",".join(HEADER)]
    for n in range(9000):
        long = "".join(rng.choices(["text ", '""quoted""', "\n", ",", "words of an opinion "], k=60)) + str(rng.random())
        rows.append(f'{n},type,"{long}","{n}\n"')
    rows[4000] = '4000,type,"' + "a line\n" * 400_000 + '",end'  # a record longer than several splits
    path = tmp_path / "opinions-2024-01-31.csv.bz2"
    path.write_bytes(bz2.compress("\n".join(rows).encode()))
    small_splits(60_000)
    lines = csv_splits.read_lines(spark, str(path))
    assert lines.select("block").distinct().count() > 3 and lines.rdd.getNumPartitions() > 3
    starts = csv_splits.split_starts(csv_splits.split_ends(lines))
    assert starts.where("inside").count() > 0
    assert in_splits(spark, str(path)) == one_task(spark, str(path))


def test_line_states():
    for line, outside, inside in [
        ("a,b", False, True), ('"a', True, False), ('a"', False, False), ('x","y', True, False), ('""', False, True),
        ('"a""b', True, False), ('"a"b,"c', True, False), ('"', True, False), ('a,"b"",', True, False), ("", False, True), ('"a" "b', False, False),
    ]:
        assert csv_splits.ends_inside(line, False) is outside, line
        if inside is not None:
            assert isinstance(csv_splits.ends_inside(line, True), bool)


def test_state_scan_is_the_composition(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for file in range(5):
        state = False
        for block in range(40):
            effect = rng.choice([(False, True), (False, True), (True, False), (True, True), (False, False)])
            rows.append((file, block, *effect))
            want[file, block] = state
            state = effect[1] if state else effect[0]
    rng.shuffle(rows)
    ends = spark.createDataFrame(rows, "file long, block long, from_outside boolean, from_inside boolean")
    assert {(r["file"], r["block"]): r["inside"] for r in csv_splits.split_starts(ends).collect()} == want


def test_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,type,plain_text,notes\n1,2,3,4\n")
    (tmp_path / "b.csv").write_text("type,id,plain_text,notes\n1,2,3,4\n")
    with pytest.raises(Exception, match="another header"):
        scan_snapshot_csv(spark, str(tmp_path), HEADER).collect()
