"""Streams that stop in the middle of a batch and go on, and state that forgets."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from figloom.sources import files
from figloom.streaming import runs

SCHEMA = "k long, at timestamp, v string"
START = datetime(2024, 1, 1)


def put(spark, rows, path):
    spark.createDataFrame([(k, START + timedelta(hours=h), v) for k, h, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_a_run_that_breaks_in_a_batch_goes_on(spark, tmp_path):
    src, sink, mark, flag = (str(tmp_path / x) for x in ("in", "out", "mark", "flag"))
    put(spark, [(1, 0, "a"), (2, 0, "b")], src)
    schema = spark.read.parquet(src).schema
    for i in range(3, 9):
        put(spark, [(i, 0, "c"), (i - 1, 0, "again")], src)
    (tmp_path / "flag").write_text("x")

    def stage(df):
        def check(batches):
            from pathlib import Path

            for b in batches:
                if Path(flag).exists() and (b["k"] == 7).any():
                    raise ValueError("broken off")
                yield b

        return df.mapInPandas(check, df.schema)

    with pytest.raises(Exception, match="broken off"):
        runs.stream_run(schema, spark, src, stage, sink, mark, "k", per_trigger=2)
    assert 0 < spark.read.schema(schema).parquet(sink).count() < 8  # batches before it are written
    (tmp_path / "flag").unlink()
    got = runs.stream_run(schema, spark, src, stage, sink, mark, "k", per_trigger=2)
    assert sorted(r["k"] for r in got.collect()) == list(range(1, 9))
    put(spark, [(8, 0, "late"), (9, 0, "new")], src)
    assert sorted(r["k"] for r in runs.stream_run(schema, spark, src, stage, sink, mark, "k").collect()) == list(range(1, 10))
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")  # the session's own setting is back


def test_keys_are_forgotten_after_the_delay(spark, tmp_path):
    src, sink, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for day in range(10):
        put(spark, [(100 * day + i, 24 * day, "x") for i in range(50)] + [(100 * day, 24 * day + 1, "twin")], src)
    schema = spark.read.parquet(src).schema
    got = runs.stream_run(schema, spark, src, lambda df: df, sink, mark, "k", per_trigger=1, time="at", within="30 hours")
    assert got.count() == 500
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in got.progress]
    assert max(kept) == 200 and len(kept) >= 10  # of ten days' keys those of four: the delay, and a batch until it is known
    whole = runs.stream_distinct(schema, spark, src, ["k"], str(tmp_path / "out2"), str(tmp_path / "mark2"), per_trigger=1)
    assert whole.count() == 500
    short = runs.stream_distinct(schema, spark, src, ["k", "v"], str(tmp_path / "out3"), str(tmp_path / "mark3"), per_trigger=1, time="at", within="1 hour")
    assert short.count() == 510


def test_annotations_with_changing_keys(spark, tmp_path):
    lines = [
        '{"a.jpg": {"scale_bars": [{"geometry": [{"x": 5, "y": 9}, {"x": 1, "y": 2.5}], "more": {"z": 1}}], "scale_labels": [{"geometry": [{"x": 0, "y": 0}, {"x": 3, "y": 4}], "text": "5 nm"}, {"text": "no box"}], "height": 7}}',
        '{"b.jpg": {"scale_labels": []}, "c.jpg": {"scale_bars": null, "scale_labels": [{"geometry": [{"x": 1, "y": 1}]}]}, "d.jpg": {"scale_bars": "none"}, "e.jpg": 5}',
        '{"broken": ', "[1, 2]", "", '{}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "j"))
    figures, rejects = files.read_annotations(spark, str(tmp_path / "j"))
    assert sorted(r["figure_name"] for r in figures.collect()) == ["a.jpg", "b.jpg", "c.jpg"]
    boxes = {tuple(r) for r in files.annotated_boxes(figures).collect()}
    assert boxes == {("a.jpg", 1, 0, 1.0, 2.5, 5.0, 9.0, None), ("a.jpg", 2, 0, 0.0, 0.0, 3.0, 4.0, "5 nm"), ("c.jpg", 2, 0, 1.0, 1.0, 1.0, 1.0, None)}
    assert sorted((r["reason"], r["text"]) for r in rejects.collect()) == [("no list of boxes", "d.jpg"), ("no list of boxes", "e.jpg"), ("no object", "[1, 2]"), ("no object", '{"broken": ')]
    train = spark.createDataFrame([("a.jpg",)], "figure_name string").select("figure_name", F.array().cast(files.ANNOTATED).alias("scale_bars"), F.array().cast(files.ANNOTATED).alias("scale_labels"))
    assert files.annotated_boxes(files.override(figures, train, ["figure_name"])).count() == 1
    (tmp_path / "one.json").write_text('{"x.jpg":\n {"scale_bars": [{"geometry": [{"x": 1, "y": 1},\n {"x": 2, "y": 2}]}]}}')
    assert files.annotated_boxes(files.read_annotations(spark, str(tmp_path / "one.json"), multi_line=True)[0]).count() == 1
