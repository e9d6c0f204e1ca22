"""Files appear when a write has succeeded as a whole, and not before."""

import pytest
from pyspark.sql import functions as F

from leafmill.sources import committed


def shown(folder):
    return {p.name: p.read_text() for p in folder.iterdir()}


def test_files_are_written_replaced_and_removed(spark, tmp_path):
    write = lambda rows: committed.write_files(spark.createDataFrame(rows, "name string, body string, extra int").repartition(3), str(tmp_path / "out"))
    write([("a.md", "one", 1), ("b.md", "ă\n", 1), ("c.md", "", 1)])
    assert shown(tmp_path / "out") == {"a.md": "one", "b.md": "ă\n", "c.md": ""}
    write([("a.md", "two", 1), ("b.md", None, 1), ("never.md", None, 1)])
    assert shown(tmp_path / "out") == {"a.md": "two", "c.md": ""}
    write([])
    assert shown(tmp_path / "out") == {"a.md": "two", "c.md": ""}


def test_a_failed_write_shows_nothing(spark, tmp_path):
    committed.write_files(spark.createDataFrame([("0.md", "old")], "name string, body string"), str(tmp_path))
    rows = spark.range(40, numPartitions=4).select(F.format_string("%d.md", "id").alias("name"), F.when(F.col("id") == 39, F.raise_error(F.lit("no more"))).otherwise("new").alias("body"))
    with pytest.raises(Exception, match="no more"):
        committed.write_files(rows, str(tmp_path))
    assert shown(tmp_path) == {"0.md": "old"}


def test_of_a_task_that_failed_once_only_the_attempt_that_counts_is_shown(tmp_path, monkeypatch):
    """Two attempts of one task stage the same names; the first one dies half-way."""
    from pyspark import TaskContext
    from pyspark.sql import Row

    writer = committed.CommittedWriter(str(tmp_path))

    def attempt(number, rows):
        monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda s: 0, "taskAttemptId": lambda s: number})()))
        return writer.write(iter(rows))

    def dying():
        yield Row(name="a.md", body="half")
        raise OSError("lost")

    with pytest.raises(OSError):
        attempt(1, dying())
    message = attempt(2, [Row(name="a.md", body="whole"), Row(name="b.md", body="b"), Row(name="c.md", body=None)])
    assert [p.name for p in tmp_path.iterdir()] == [writer.staging]
    writer.commit([message, None])
    assert shown(tmp_path) == {"a.md": "whole", "b.md": "b"}
