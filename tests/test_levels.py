import random

import pytest

from tables import rows
from tidemark.operators.state import latest_state
from tidemark.sources.manifest import VerificationError
from tidemark.streaming import levels

LOG = "k bigint, source_lsn bigint, v string, is_deleted int"


def batches(n, size, seed=1):
    draw, lsn = random.Random(seed), iter(range(1, 10**6))
    return [[(draw.randint(1, 400), next(lsn), f"v{b}", int(draw.random() < 0.1)) for _ in range(size)] for b in range(n)]


def test_levels_equal_the_log_and_a_lookup_reads_few_files(spark, tmp_path):
    table, all_rows = str(tmp_path / "t"), []
    parts = batches(13, 60)
    random.Random(2).shuffle(parts)
    for part in [*parts, parts[3]]:
        all_rows += part
        now = levels.add_batch(spark.createDataFrame(part, LOG).repartition(2), table, ["k"], fanout=2)
    runs = {(e.level, e.path.split("/")[0]) for e in now.entries}
    assert len(runs) <= 2 * 4 and max(level for level, _ in runs) >= 2
    log = spark.createDataFrame(all_rows, LOG)
    want = rows(latest_state(log, ["k"]))
    assert rows(levels.read_levels(spark, table, ["k"])) == want
    some = list(range(100, 110))
    assert rows(levels.read_levels(spark, table, ["k"], lookup=some)) == [r for r in want if r[0] in some]
    files = levels.files_of(spark, table, some)
    assert len(files) <= 2 * len(runs) and all(e.low <= 109 and e.high >= 100 for e in files)
    assert rows(levels.read_levels(spark, table, ["k"], lookup=[10**9])) == []
    assert rows(levels.read_levels(spark, table, ["k"], lookup=[])) == []


def test_tombstones_go_at_the_last_level_once_settled(spark, tmp_path):
    first, second = [(1, 1, "a", 0), (2, 2, "b", 0)], [(1, 3, "a", 1), (2, 4, "b", 1)]
    for settled, left in ((None, {1, 2}), (3, {2}), (9, set())):
        table = str(tmp_path / str(settled))
        for part in (first, second):
            now = levels.add_batch(spark.createDataFrame(part, LOG), table, ["k"], settled=settled, fanout=2)
        assert {e.level for e in now.entries} <= {1}
        stored = spark.read.parquet(*[f"{table}/{e.path}" for e in now.entries]) if now.entries else None
        assert ({r.k for r in stored.collect()} if stored else set()) == left
        assert rows(levels.read_levels(spark, table, ["k"])) == []
    levels.add_batch(spark.createDataFrame(first, LOG), str(tmp_path / "None"), ["k"], fanout=2)
    assert rows(levels.read_levels(spark, str(tmp_path / "None"), ["k"])) == []


def test_rows_without_a_key_are_refused(spark, tmp_path):
    with pytest.raises(VerificationError):
        levels.add_batch(spark.createDataFrame([(None, 1, "a", 0)], LOG), str(tmp_path / "t"), ["k"])
    with pytest.raises(FileNotFoundError):
        levels.read_levels(spark, str(tmp_path / "t"), ["k"])


def test_named_columns_only_are_read(spark, tmp_path):
    table = str(tmp_path / "t")
    for part in ([(1, 1, "a", 0), (2, 2, "b", 0)], [(2, 3, "c", 1), (3, 4, "d", 0)]):
        levels.add_batch(spark.createDataFrame(part, LOG), table, ["k"])
    got = levels.read_levels(spark, table, ["k"], columns=["k", "is_deleted"])
    assert rows(got) == [(1, 0), (3, 0)]
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "source_lsn" in scan and "v#" not in scan


def test_a_merge_moves_the_rows_once(spark, tmp_path, monkeypatch):
    plans, write = [], levels._write_run

    def seen(rows, table, key, level, collapse=lambda dealt: dealt):
        plans.append((level, collapse(rows.repartitionByRange(key))._jdf.queryExecution().executedPlan().toString()))
        return write(rows, table, key, level, collapse)

    monkeypatch.setattr(levels, "_write_run", seen)
    for lsn in (1, 2):
        levels.add_batch(spark.createDataFrame([(7, lsn, "a", 0), (8, lsn, "b", 0)], LOG), str(tmp_path / "t"), ["k"], fanout=2)
    assert [plan.count("Exchange ") for level, plan in plans if level] == [1]
    assert rows(levels.read_levels(spark, str(tmp_path / "t"), ["k"])) == [(7, 2, "a", 0), (8, 2, "b", 0)]
