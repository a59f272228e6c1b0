"""Queries of evaluation, sources, sinks and streams."""

import uuid

from pyspark.sql import functions as F

from figloom.functions.session import materialise, shared_dir
from figloom.operators import detections as det
from figloom.operators import evaluation as ev
from figloom.operators import geometry as geo
from figloom.plans.box_queries import BOX, IMAGED, box, imaged
from figloom.plans.fixtures import ctes, derived, given
from figloom.plans.registry import query
from figloom.sources import files
from figloom.streaming import runs

G = "figure_id"


def _points(df):
    return df.select(G, "idx", *geo.center())


@query("i1_match_truth")
def i1(spark, d):
    b = box(spark, d)
    return ev.match_truth(_points(b.where("kind = 1")), _points(b.where("kind = 2").withColumn("x1", F.col("x1") - 60)), G, near=20_000.0)


_LN = ctes("lbl") + ", v as (select *, trunc(cast(regexp_extract(text, '^([0-9]+)', 1) as double)) as nm from lbl)"


@query("i2_nm_error", f"{_LN} select figure_id, idx, nm, nm + 1 as true_nm, round(abs(nm - (nm + 1)) / (nm + 1), 6) as error from v")
def i2(spark, d):
    nm = derived(spark, d, "lbl").select(G, "idx", F.regexp_extract("text", "^([0-9]+)", 1).cast("double").alias("nm"))
    return ev.nm_error(nm, nm.withColumn("nm", F.col("nm") + 1), [G, "idx"]).withColumn("error", F.round("error", 6))


@query("i3_accuracy_at", "select threshold, count(*) as n, round(avg(case when toxic = (doc_id % 7 = 0)::int then 1 else 0 end), 6) as accuracy from labels, (values (0.6e0), (0.9e0)) t(threshold) where (doc_id % 100) / 100.0e0 >= threshold group by threshold")
def i3(spark, d):
    s = given(spark, d, "labels").select((F.col("doc_id") % 100 / 100.0).alias("confidence"), (F.col("toxic") == (F.col("doc_id") % 7 == 0).cast("int")).alias("correct"))
    return ev.accuracy_at(s, [0.6, 0.9]).withColumn("accuracy", F.round("accuracy", 6))


@query("i4_class_accuracy", """with e as (select vec_id % 3 as model, concat('c', cast(label as varchar)) as class_name, label % 5 as predicted from embeddings), c(class_name, class_index) as (values ('c0', 0), ('c1', 1), ('c2', 2), ('c6', 3))
  select cast(model as bigint) as model, round(avg(case when class_index is not null then (class_index = predicted)::int end), 6) as accuracy, count(*) filter (class_index is null) as skipped from e left join c using (class_name) group by model""")
def i4(spark, d):
    e = given(spark, d, "embeddings").select((F.col("vec_id") % 3).cast("long").alias("model"), F.concat(F.lit("c"), F.col("label").cast("string")).alias("class_name"), (F.col("label") % 5).alias("predicted"))
    classes = spark.createDataFrame([("c0", 0), ("c1", 1), ("c2", 2), ("c6", 3)], "class_name string, class_index int")
    return ev.class_accuracy(e, classes).withColumn("accuracy", F.round("accuracy", 6))


_ANN = f"{BOX}, ann as (select figure_id, cast(row_number() over (partition by figure_id order by idx) as int) as id, kind + 1 as category, x1 as x, y1 as y, x2 - x1 as w, y2 - y1 as h, (x2 - x1) * (y2 - y1) as area from box)"


@query("i5_annotations", f"{_ANN} select * from ann")
def i5(spark, d):
    return ev.to_annotations(box(spark, d), G)


@query("i6_clean_annotations", f"""{BOX} select figure_id, idx, x1, y1, x2, y2 from (select figure_id, idx, least(greatest(x1, 0), width) as x1, least(greatest(y1, 0), height) as y1, least(greatest(x2, 0), width) as x2, least(greatest(y2, 0), height) as y2 from {IMAGED} where idx % 5 <> 0) where x2 > x1 and y2 > y1""")
def i6(spark, d):
    return ev.clean_annotations(imaged(box(spark, d)).withColumn("crowd", F.col("idx") % 5 == 0)).select(G, "idx", "x1", "y1", "x2", "y2")


@query("i7_drop_empty_images", f"{_ANN} select distinct figure_id from ann where figure_id % 7 <> 0 and w > 1 and h > 1")
def i7(spark, d):
    b = box(spark, d)
    return ev.drop_empty_images(b.select(G).distinct(), ev.to_annotations(b, G).withColumn("w", F.when(F.col(G) % 7 == 0, F.lit(1)).otherwise(F.col("w"))), G)


@query("i8_remap_categories", f"{_ANN} select figure_id, id, case category when 3 then 0 else 1 end as category from ann where category in (1, 3)")
def i8(spark, d):
    a = ev.to_annotations(box(spark, d), G).withColumn("category", F.col("category").cast("int"))
    return ev.remap_categories(a, [3, 1]).select(G, "id", "category")


@query("i9_average_precision")
def i9(spark, d):
    b = box(spark, d)
    shifted = b.withColumn("x1", F.col("x1") + F.col("idx").cast("int") % 3).withColumn("confidence", F.round("confidence", 2))
    return ev.average_precision(b.where("kind = 0"), shifted.where("idx % 4 != 1"), G, [0.5, 0.75, 0.9])


@query("i9_detection_summary")
def i9_summary(spark, d):
    b = box(spark, d)
    shifted = b.where("kind = 0").withColumn("x1", F.col("x1") + F.col("idx").cast("int") % 3).withColumn("confidence", F.round("confidence", 2))
    truth, found = b.where("kind = 0"), materialise(shifted.union(shifted.withColumns({"idx": F.col("idx") + 100, "x2": F.col("x2") + 2, "confidence": F.col("confidence") / 2})))
    after = found.join(det.nms_overlap(found, G, 0.5).select(G, "idx"), [G, "idx"], "left_semi")
    told = ev.detection_summary(truth, found, G).withColumnRenamed("value", "before").join(ev.detection_summary(truth, after, G).withColumnRenamed("value", "after"), "metric")
    return told.select("metric", *(F.round(c, 6).alias(c) for c in ("before", "after")))


@query("i10_smooth", """with s as (select event_type, event_id, value, row_number() over (partition by event_type order by event_id) as r from events),
  l as (select a.event_type, a.event_id, list(b.value order by b.value) as v from s a join s b on b.event_type = a.event_type and b.r between a.r - 19 and a.r group by all)
  select event_type, event_id, round(list_avg(v) + 1e-7, 4) as mean, round(v[-1] + 1e-7, 4) as most, round(v[(len(v) - 1) // 2 + 1] + 1e-7, 4) as median, round(value + 1e-7, 4) as last, round(avg(value) over (partition by event_type order by event_id rows unbounded preceding) + 1e-7, 4) as global_mean from l join s using (event_type, event_id)""")
def i10(spark, d):
    out = ev.smooth(given(spark, d, "events"), "event_type", ["event_id"], "value")
    return out.select("event_type", "event_id", *(F.round(F.col(c) + 1e-7, 4).alias(c) for c in ("mean", "most", "median", "last", "global_mean")))


@query("i11_reduce_metrics", "select event_type, round(avg(value), 6) as value from events group by event_type")
def i11(spark, d):
    return ev.reduce_metrics(given(spark, d, "events"), "event_type", "value").withColumn("value", F.round("value", 6))


@query("i12_sample_figures")
def i12(spark, d):
    return ev.sample_figures(derived(spark, d, "cap"), G, 25, 7).select(G)


@query("i13_diff_results", "select o_orderkey, case when o_orderkey % 11 = 0 then 'extra' when o_orderkey % 13 = 0 then 'missing' else 'different' end as state from orders where (o_orderkey % 11 = 0) <> (o_orderkey % 13 = 0) or (o_orderkey % 17 = 0 and o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0)")
def i13(spark, d):
    o = given(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"), "o_orderstatus")
    expected = o.where("o_orderkey % 11 != 0").withColumn("price", F.col("price") + F.when(F.col("o_orderkey") % 17 == 0, 5.0).otherwise(0.0001))
    return ev.diff_results(o.where("o_orderkey % 13 != 0").withColumn("price", F.round("price", 2) + 0.0), expected.withColumn("price", F.round("price", 2)), "o_orderkey")


def scratch(spark) -> str:
    return f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"


@query("a2_read_pages", "select page_id, url, length(html) as n_chars from pages")
def a2(spark, d):
    return files.read_pages(spark, f"{d}/pages.parquet").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query("a3_archive_pages", "select page_id, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') as host from pages")
def a3(spark, d):
    path = scratch(spark)
    files.archive_pages(given(spark, d, "pages"), path)
    return spark.read.parquet(path).select("page_id", F.col("host").cast("string").alias("host"))


@query("a4_figure_json", f"{ctes('cap')} select concat(cast(figure_id as varchar), '_fig1.jpg') as figure_name, caption as full_caption from cap")
def a4(spark, d):
    path = scratch(spark)
    figs = derived(spark, d, "cap").select(F.concat(F.col(G).cast("string"), F.lit("_fig1.jpg")).alias("figure_name"), F.col("caption").alias("full_caption"))
    files.write_figures(figs, path)
    return files.read_figures(spark, path, figs.schema)


@query("a7_csv_tables", "select cast(c_custkey as varchar) as doi, c_name as title from customer")
def a7(spark, d):
    path = scratch(spark)
    files.write_tables({"article": given(spark, d, "customer").select("c_custkey", "c_name")}, path)
    return spark.read.schema("doi string, title string").csv(f"{path}/article")


@query("a8_insert_ignore", "select o_orderkey, case when o_orderkey % 2 = 0 then 'old' else 'new' end as run from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0")
def a8(spark, d):
    o = given(spark, d, "orders").select("o_orderkey")
    target = o.where("o_orderkey % 2 = 0").withColumn("run", F.lit("old"))
    new = o.where("o_orderkey % 3 = 0").withColumn("run", F.lit("new"))
    return files.insert_ignore(target, new.union(new), "o_orderkey")


@query("a9_documents", f"{ctes('cap')} select figure_id, caption from cap")
def a9(spark, d):
    docs = files.to_documents(derived(spark, d, "cap"))
    return docs.select(F.get_json_object("document", "$.figure_id").cast("long").alias(G), F.get_json_object("document", "$.caption").alias("caption"))


@query("a10_annotation_union", f"{BOX} select figure_id, idx, case when kind in (0, 1) then 'train' else 'test' end as part from box")
def a10(spark, d):
    b = box(spark, d).select(G, "idx", "kind")
    return files.override(b.where("kind in (1, 2)").withColumn("part", F.lit("test")), b.where("kind in (0, 1)").withColumn("part", F.lit("train")), [G, "idx"]).select(G, "idx", "part")


@query("a10_annotation_scan", f"""{ctes("box", "lbl")}, o as (select o_orderkey as figure_id, o_orderstatus = 'F' as train from orders)
  select concat(cast(figure_id as varchar), '.jpg') as figure_name, kind as category, cast(row_number() over (partition by figure_id, kind order by idx) - 1 as int) as pos, cast(case when train then x1 + 1 else x1 end as double) as x1, cast(y1 as double) as y1, cast(x2 as double) as x2, cast(y2 as double) as y2,
  case when kind = 2 then text end as text from box join lbl using (figure_id, idx) join o using (figure_id) where kind <> 0""")
def a10s(spark, d):
    """Two sets of annotations, written as JSON with a broken line each and read back; the training set's figures override."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    b = box(spark, d).where("kind != 0").join(derived(spark, d, "lbl").select(G, "idx", "text"), [G, "idx"]).join(given(spark, d, "orders").select(F.col("o_orderkey").alias(G), (F.col("o_orderstatus") == "F").alias("train")), G)

    def written(df):
        one = F.struct("idx", F.array(corner("x1", "y1"), corner("x2", "y2")).alias("geometry"), F.when(F.col("kind") == 2, F.col("text")).alias("text"))
        lists = {k: F.sort_array(F.collect_list(F.when(F.col("kind") == n, one))) for k, n in (("scale_bars", 1), ("scale_labels", 2))}
        lines = df.groupBy(G).agg(*(v.alias(k) for k, v in lists.items())).select(F.to_json(F.create_map(F.concat(F.col(G).cast("string"), F.lit(".jpg")), F.struct(*lists))).alias("value"))
        path = scratch(spark)
        lines.union(spark.createDataFrame([('{"broken": ',)], "value string")).write.text(path)
        return files.read_annotations(spark, path)[0]

    test, train = written(b), written(b.where("train").withColumn("x1", F.col("x1") + 1))
    return files.annotated_boxes(files.override(test, train, ["figure_name"]))


@query("a1_read_query", "select r_name as name, 'place' as field, r_name as term from region union all select r_name, 'place', n_name from region join nation on n_regionkey = r_regionkey")
def a1(spark, d):
    """Search configurations, a region each, written as JSON and read back."""
    places = given(spark, d, "region").join(given(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.collect_list("n_name").alias("synonyms"))
    one = F.struct(F.col("r_name").alias("name"), F.create_map(F.lit("place"), F.struct(F.col("r_name").alias("term"), "synonyms")).alias("query"))
    path = scratch(spark)
    places.agg(F.to_json(F.collect_list(one)).alias("value")).write.text(path)
    return files.read_query(spark, path)


@query("a5_write_figures", "select doc_id, length(text) as n, lang, source from documents")
def a5(spark, d):
    docs, path = given(spark, d, "documents").select("doc_id", "text", F.struct("lang", "source").alias("of")), scratch(spark)
    files.write_figures(docs, path)
    return files.read_figures(spark, path, docs.schema).select("doc_id", F.length("text").cast("long").alias("n"), "of.lang", "of.source")


@query("a6_read_images", "select page_id, strlen(html) + 1 as length from pages")
def a6(spark, d):
    """Pages as files of bytes, a folder each, and a newline at their end."""
    path = scratch(spark)
    given(spark, d, "pages").select("page_id", F.col("html").alias("value")).write.partitionBy("page_id").text(path)
    found = files.read_images(spark, path, "*.txt").withColumn("path", F.input_file_name())
    return found.select(F.regexp_extract("path", "page_id=([0-9]+)/", 1).cast("long").alias("page_id"), F.length("content").cast("long").alias("length"))


@query("a11_pending", "select event_id from events where event_type <> (select min(event_type) from events)")
def a11(spark, d):
    e = given(spark, d, "events")
    done = e.join(e.agg(F.min("event_type").alias("event_type")), "event_type", "left_semi")
    return files.pending(e, done.select("event_id"), "event_id").select("event_id")


@query("j1_stream_run", "select user_id, count(*) as n, round(sum(value), 4) as total from events where value > 10 group by user_id")
def j1(spark, d):
    def stage(df):
        return df.where("value > 10").select("event_id", "user_id", "value")

    out = runs.stream_run(given(spark, d, "events").schema, spark, f"{d}/events.parquet", stage, scratch(spark), scratch(spark), "event_id")
    return out.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("j2_stream_distinct", "select distinct user_id, event_type from events")
def j2(spark, d):
    return runs.stream_distinct(given(spark, d, "events").schema, spark, f"{d}/events.parquet", ["user_id", "event_type"], scratch(spark), scratch(spark))
