import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from numberplace.operators import sampling
from numberplace.operators.sampling import (
    inside_circle,
    partition_ids,
    sample_exact,
    sample_native,
    stream,
)


# Points inside the circle out of 500 drawn with Python's own generator.
INSIDE_OF_500 = {
    0: 387, 1: 387, -7: 380, 2**32 - 1: 401, 2**32: 403, 2**45 + 3: 394, 2**70: 386,
}


def test_published_result(spark):
    row = sample_exact(partition_ids(spark, 4)).first()
    assert (row.inside_points, row.pi, row.pi_text) == (785_050, 3.1402, "3.14020000")
    assert (row.partitions, row.points_per_partition, row.total_points) == (4, 250_000, 1_000_000)


def test_counts_per_partition():
    assert [inside_circle(20260917 + p, 250_000) for p in range(4)] == [196417, 196254, 196074, 196305]


@pytest.mark.parametrize("seed", INSIDE_OF_500)
def test_streams_are_pythons(seed):
    assert list(stream(seed).random_sample(20)) == [d.random() for d in [random.Random(seed)] for _ in range(20)]
    assert inside_circle(seed, 500) == INSIDE_OF_500[seed]


def test_chunks_do_not_matter(monkeypatch):
    whole = inside_circle(5, 10_000)
    monkeypatch.setattr(sampling, "_CHUNK", 77)
    assert inside_circle(5, 10_000) == whole == 7_850


@pytest.mark.parametrize("sample", [sample_exact, sample_native])
def test_layout_does_not_matter(spark, sample):
    ids = partition_ids(spark, 9)
    rows = {tuple(sample(df, 3_001).first()) for df in (ids, ids.coalesce(1), ids.repartition(4))}
    assert len(rows) == 1
    assert rows.pop()[:3] == (9, 3_001, 27_009)


def test_ids_from_a_table(spark):
    ids = spark.createDataFrame([(3,), (8,)], "key int")
    row = sample_exact(ids, 400, 11, "key").first()
    assert row.inside_points == 632


def test_native_estimate_is_near(spark):
    row = sample_native(partition_ids(spark, 4)).first()
    assert row.total_points == 1_000_000
    assert abs(row.pi - 3.14159265) < 0.01
    assert sample_native(partition_ids(spark, 4), seed=1).first().inside_points != row.inside_points


def test_native_sampling_needs_no_python_worker(spark):
    plan = sample_native(partition_ids(spark, 4))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_tasks_carry_their_functions_with_them(tmp_path):
    """A worker that cannot import the package counts all the same."""
    task = tmp_path / "task"
    task.write_bytes(cloudpickle.dumps(inside_circle))
    code = f"import pickle; print(pickle.load(open({str(task)!r}, 'rb'))(20260917, 250_000))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert int(ran.stdout) == 196417


def test_nothing_to_sample_is_refused(spark):
    with pytest.raises(ValueError):
        partition_ids(spark, 0)
    for sample in (sample_exact, sample_native):
        with pytest.raises(ValueError):
            sample(spark.range(1), 0)
