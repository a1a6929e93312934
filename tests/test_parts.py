import pytest
from pyspark.sql import functions as F

from basketlake.sources import parts

SCHEMA = "k int, v bigint, m string"


def rows_of(spark, path, **options):
    return sorted(tuple(r) for r in parts.read(spark, path, SCHEMA, **options).collect())


def batch(spark, i):
    return spark.createDataFrame([(i, 1, "x"), (0, i, "y")], SCHEMA).coalesce(1)


def files(folder):
    return len(list(folder.rglob("*.parquet")))


def test_many_batches_leave_few_files(spark, tmp_path):
    path, counts, want = str(tmp_path / "t"), [], []
    for i in range(24):
        parts.write(batch(spark, i), path, i, ["m"])
        parts.compact(spark, path, SCHEMA, i, ["m"], fan_out=4)
        want += [(i, 1, "x"), (0, i, "y")]
        counts.append(len(parts.live(spark, path)))
        assert files(tmp_path / "t") <= 2 * counts[-1]
    assert max(counts[:16]) <= 7 and max(counts) <= 8  # three folders a level, and the open batch
    assert rows_of(spark, path) == sorted(want)
    assert rows_of(spark, path, before=23) == sorted(want[:-2])
    # The newest batch once more, as after a crash: it replaces itself.
    parts.write(batch(spark, 23), path, 23, ["m"])
    assert rows_of(spark, path) == sorted(want)


def test_merging_may_sum_up(spark, tmp_path):
    path = str(tmp_path / "t")
    fold = lambda df: df.groupBy("k", "m").agg(F.sum("v").alias("v")).select("k", "v", "m")
    for i in range(9):
        parts.write(batch(spark, i), path, i)
    assert parts.compact(spark, path, SCHEMA, 9, fold=fold, fan_out=3) == 4
    assert [(p.first, p.last) for p in parts.live(spark, path)] == [(0, 8)]
    assert rows_of(spark, path) == sorted([(0, sum(range(9)), "y"), *[(i, 1, "x") for i in range(9)]])


def test_a_merge_that_broke_off_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        parts.write(batch(spark, i), path, i)
    want = rows_of(spark, path)
    # Broken while writing: no marker, so the wider folder does not count.
    wide = tmp_path / "t" / "batches=0_3"
    parts.read(spark, path, SCHEMA).write.parquet(str(wide))
    marker = (wide / "_SUCCESS").read_bytes()
    (wide / "_SUCCESS").unlink()
    assert rows_of(spark, path) == want
    # Broken after writing: it counts, and those inside it do not.
    (wide / "_SUCCESS").write_bytes(marker)
    assert rows_of(spark, path) == want and len(parts.live(spark, path)) == 1
    parts.compact(spark, path, SCHEMA, 4)
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["batches=0_3"] and rows_of(spark, path) == want
    # Another checkpoint counts from 0 again: its batch 2 is not the merged one.
    with pytest.raises(ValueError, match="checkpoint"):
        parts.write(batch(spark, 2), path, 2)


def test_measures_and_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert rows_of(spark, path) == [] and parts.live(spark, path) == []
    assert parts.write(batch(spark, 0), path, 0, measures={"n": F.count(F.lit(1)), "most": F.max("v")}) == {"n": 2, "most": 1}
    assert parts.write(batch(spark, 1).where("false"), path, 1, measures={"n": F.count(F.lit(1))}) == {"n": 0}
    assert len(rows_of(spark, path)) == 2 and parts.read_batch(spark, path, SCHEMA, 1).count() == 0
