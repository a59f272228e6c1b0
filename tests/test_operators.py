"""Small worked cases of the decisions that the queries' twins don't show."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from figloom.operators import captions, detections, evaluation, geometry, pages, scale, search, tables
from figloom.sources import files
from figloom.streaming import runs


def boxes(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "figure_id long, idx int, x1 int, y1 int, x2 int, y2 int, confidence double")


def test_suppression_keeps_the_surest(spark):
    b = boxes(spark, [(0, 0, 10, 10, 0.5), (1, 1, 11, 11, 0.9), (40, 40, 50, 50, 0.1), (0, 0, 10, 10, 0.5)])
    assert [r["idx"] for r in detections.nms_iou(b, "figure_id", 0.3).orderBy("idx").collect()] == [1, 2]
    assert [r["idx"] for r in detections.nms_overlap(b, "figure_id", 0.5).orderBy("idx").collect()] == [1, 2]
    assert detections.nms_iou(b, "figure_id", 0.3, limit=1).count() == 1


def test_containment_is_strict(spark):
    b = boxes(spark, [(0, 0, 10, 10, 1.0), (0, 1, 9, 9, 1.0), (1, 1, 9, 9, 1.0)])
    got = geometry.contained(b.where("idx > 0"), b.where("idx = 0"), "figure_id").collect()
    assert [r["in_idx"] for r in got] == [2]


@pytest.mark.parametrize("text,nm", [("20 nm", 20.0), ("0.5 um", 500.0), ("3n", 3.0), ("1.239 A", 0.12), ("5 px", None), ("nm", None)])
def test_label_to_nanometres(spark, text, nm):
    assert scale.to_nm(spark.createDataFrame([(text,)], "text string")).first()["nm"] == nm


def test_nearest_label_first_of_equals_and_limit(spark):
    lines = boxes(spark, [(0, 0, 10, 2, 1.0), (500, 500, 510, 502, 1.0)])
    labels = boxes(spark, [(0, 20, 10, 22, 1.0), (20, 0, 30, 2, 1.0)])
    got = {r["line_idx"]: (r["label_idx"], r["distance"]) for r in scale.nearest_label(lines, labels, "figure_id").collect()}
    assert got == {0: (0, 400.0), 1: (None, -1.0)}
    assert scale.nearest_label(lines, labels, "figure_id", keep_unmatched=False).count() == 1


@pytest.mark.parametrize("span,want", [("(a–c, e and f)", "abcef"), ("(b)", "b"), ("(A-C)", "ABC"), ("(2-4)", "234")])
def test_implied_labels(spark, span, want):
    assert "".join(spark.range(1).select(captions.implied_labels(F.lit(span)).alias("l")).first()["l"]) == want


def test_roman_range(spark):
    assert spark.range(1).select(captions.implied_labels(F.lit("(ii-iv)")).alias("l")).first()["l"] == ["ii", "iii", "iv"]


def test_segments_leading_trailing_and_references(spark):
    caps = spark.createDataFrame([(1, "Both. (a) First part shown in (b) here. (b) Second."), (2, "TEM of gold (a) and of iron (b)."), (3, "No labels")], "figure_id long, caption string")
    got = {(r["figure_id"], r["span"]): r["segment"] for r in captions.segments(caps, "figure_id").collect()}
    assert got == {(1, "(a)"): "First part shown in (b) here.", (1, "(b)"): "Second.", (2, "(a)"): "TEM of gold", (2, "(b)"): "and of iron"}


def test_likely_label(spark):
    row = spark.createDataFrame([(["b", "d"], "x (a) y (e, 5)")], "s array<string>, t string")
    got = row.select(*(captions.likely_label(F.lit(x), F.col("s"), F.col("t")).alias(x) for x in "aceqz")).first()
    assert got.asDict() == {"a": True, "c": True, "e": True, "q": False, "z": False}


def test_similar_texts_go(spark):
    d = spark.createDataFrame([(1, 0, "silver particles on carbon"), (1, 1, "silver particles on a carbon film"), (1, 2, "an x-ray spectrum")], "g long, seq int, t string")
    assert [r["seq"] for r in captions.prune_similar(d, "g", "seq", "t", 0.7).orderBy("seq").collect()] == [1, 2]


def test_captions_one_to_one(spark):
    sub = spark.createDataFrame([(1, 0, "A"), (1, 1, "a"), (1, 2, "q")], "figure_id long, idx int, label string")
    cap = spark.createDataFrame([(1, 0, "(a).", ["x"], ["k"], [])], "figure_id long, pos int, label string, caption array<string>, keywords array<string>, general array<string>")
    got = {r["idx"]: r["caption"] for r in tables.assign_captions(sub, cap, "figure_id").collect()}
    assert got == {0: ["x"], 1: [], 2: []}
    assert tables.unassigned_captions(sub, cap, "figure_id").count() == 0


def test_open_false_means_closed(spark):
    sub = spark.createDataFrame([("s1", "f1"), ("s2", "f2")], "subfigure_id string, figure_id string")
    fig = spark.createDataFrame([("f1", "d1"), ("f2", "d2")], "figure_id string, article_id string")
    art = spark.createDataFrame([("d1", True), ("d2", False)], "doi string, open boolean")
    assert [r["subfigure_id"] for r in search.by_open(sub, fig, art, False).collect()] == ["s2"]


def test_exclusive_match(spark):
    t = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 5.0, 0.0)], "figure_id long, idx int, cx double, cy double")
    p = spark.createDataFrame([(1, 0, 4.0, 0.0), (1, 1, 90.0, 0.0)], "figure_id long, idx int, cx double, cy double")
    assert tuple(evaluation.match_truth(t, p, "figure_id").first())[1:] == (1, 1, 1)


def test_perfect_detections_have_precision_one(spark):
    b = boxes(spark, [(0, 0, 10, 10, 0.9), (20, 20, 40, 40, 0.8)])
    got = evaluation.average_precision(b, b, "figure_id", [0.5, 0.9]).collect()
    assert all(abs(r["ap"] - 1) < 1e-9 and r["recall"] == 1 for r in got) and len(got) == 2


def test_bad_pages_are_set_apart(spark):
    p = spark.createDataFrame([(1, None), (2, "<title>x</title><p>y</p>"), (3, "<p>z</p>")], "page_id long, html string")
    good, bad = pages.safe_extract(p, "page_id")
    assert [r["page_id"] for r in good.collect()] == [2] and {r["reason"] for r in bad.collect()} == {"no page", "no title"}


def test_query_configuration_images_and_ledger(spark, tmp_path):
    (tmp_path / "q.json").write_text('{"name": "n", "query": {"m": {"term": "gold", "synonyms": ["Au", "gold film"]}, "t": {"term": "TEM"}}}')
    assert {(r["field"], r["term"]) for r in files.read_query(spark, str(tmp_path / "q.json")).collect()} == {("m", "gold"), ("m", "Au"), ("m", "gold film"), ("t", "TEM")}
    (tmp_path / "img").mkdir()
    for n in ("a.png", "b.jpg", "c.txt"):
        (tmp_path / "img" / n).write_bytes(b"123")
    assert {r["figure_name"] for r in files.read_images(spark, str(tmp_path / "img")).collect()} == {"a.png", "b.jpg"}
    done = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    for _ in range(2):
        files.append_done(done, str(tmp_path / "ledger"), "k")
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "ledger")).collect()) == [1, 2]


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    src, sink, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = spark.createDataFrame([Row(k=1, v=1)]).schema
    spark.createDataFrame([(1, 1), (2, 2)], schema).write.parquet(src)
    runs.stream_run(schema, spark, src, lambda df: df, sink, mark, "k")
    spark.createDataFrame([(2, 9), (3, 3)], schema).write.mode("append").parquet(src)
    got = runs.stream_run(schema, spark, src, lambda df: df, sink, mark, "k")
    assert {(r["k"], r["v"]) for r in got.collect()} == {(1, 1), (2, 2), (3, 3)}


def test_crop_has_the_box_size(spark):
    images = spark.createDataFrame([(1, 4, 3, 1, bytearray(range(12)))], "figure_id long, width int, height int, channels int, data binary")
    b = spark.createDataFrame([(1, 0, 1, 1, 3, 3)], "figure_id long, idx int, x1 int, y1 int, x2 int, y2 int")
    r = geometry.crop(images, b).first()
    assert (r["width"], r["height"], bytes(r["data"])) == (2, 2, bytes([5, 6, 9, 10]))


def test_many_folders_of_images_are_listed_by_few_tasks(spark, tmp_path):
    for k in range(70):
        (tmp_path / f"page_id={k}").mkdir()
        (tmp_path / f"page_id={k}" / "a.png").write_bytes(b"x" * (k + 1))
    was = spark.conf.get(files.LISTING)
    images = files.read_images(spark, str(tmp_path))
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    last = max((stages.apply(i) for i in range(stages.size())), key=lambda x: x.stageId())
    assert 1 < last.numTasks() <= files.LISTED * sc.defaultParallelism
    assert spark.conf.get(files.LISTING) == was
    assert sorted(r[0] for r in images.select("length").collect()) == list(range(1, 71))
