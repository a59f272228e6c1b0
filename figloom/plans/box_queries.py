"""Queries of geometry, detections and scale over the derived boxes."""

from pyspark.sql import functions as F

from figloom.operators import detections as det
from figloom.operators import geometry as geo
from figloom.operators import scale
from figloom.plans.fixtures import ctes, derived, given
from figloom.plans.registry import query

G = "figure_id"
BOX = ctes("box")
XY = "x1, y1, x2, y2"


def box(spark, d):
    return derived(spark, d, "box")


def imaged(df):
    """Each figure's image size, told by its id."""
    return df.withColumn("width", (F.lit(200) + F.col(G) % 200).cast("int")).withColumn("height", (F.lit(150) + F.col(G) % 150).cast("int"))


IMAGED = "(select *, cast(200 + figure_id % 200 as int) as width, cast(150 + figure_id % 150 as int) as height from box)"


@query("d1_to_box", f"{BOX} select figure_id, idx, {XY} from box")
def d1(spark, d):
    return box(spark, d).withColumn("p", geo.to_corners()).select(G, "idx", *geo.to_box(F.col("p")))


@query("d2_to_corners", f"""{BOX} select figure_id, idx, 0 as pos, x1 as x, y1 as y from box union all select figure_id, idx, 1, x1, y2 from box
  union all select figure_id, idx, 2, x2, y1 from box union all select figure_id, idx, 3, x2, y2 from box""")
def d2(spark, d):
    return box(spark, d).select(G, "idx", F.posexplode(geo.to_corners()).alias("pos", "p")).select(G, "idx", "pos", "p.x", "p.y")


@query("d3_center", f"{BOX} select figure_id, idx, cast((x1 + x2) / 2.0 as double) as cx, cast((y1 + y2) / 2.0 as double) as cy from box")
def d3(spark, d):
    return box(spark, d).select(G, "idx", *(c.cast("double") for c in geo.center()))


@query("d4_contained", f"""{BOX} select o.figure_id, i.idx as in_idx, o.idx as out_idx from box o join box i using (figure_id)
  where o.kind = 0 and i.kind <> 0 and i.x1 > o.x1 - 2 and i.y1 > o.y1 - 2 and i.x2 < o.x2 + 2 and i.y2 < o.y2 + 2""")
def d4(spark, d):
    b = box(spark, d)
    return geo.contained(b.where("kind != 0"), b.where("kind = 0"), G, pad=2).select(G, "in_idx", "out_idx")


_W5, _H5 = "(least(a.x2, b.x2) - greatest(a.x1, b.x1))", "(least(a.y2, b.y2) - greatest(a.y1, b.y1))"


@query("d5_iou", f"""{BOX} select figure_id, a.idx as a_idx, b.idx as b_idx, round(cast({_W5} * {_H5} as double) / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_W5} * {_H5}), 6) as iou
  from box a join box b using (figure_id) where a.idx < b.idx and {_W5} > 0 and {_H5} > 0""")
def d5(spark, d):
    return geo.iou_pairs(box(spark, d), G, "idx").select(G, "a_idx", "b_idx", F.round("iou", 6).alias("iou"))


@query("d6_convert", f"{BOX} select figure_id, idx, x2 - x1 as w, y2 - y1 as h, cast((x1 + x2) / 2.0 as double) as cx, cast((y1 + y2) / 2.0 as double) as cy from box")
def d6(spark, d):
    return geo.convert(box(spark, d)).select(G, "idx", "w", "h", F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy"))


@query("d7_letterbox", f"""{BOX} select figure_id, idx, round((x1 + (s - width) / 2.0) * 416 / s, 4) as lx1, round((y1 + (s - height) / 2.0) * 416 / s, 4) as ly1,
  round((x2 + (s - width) / 2.0) * 416 / s, 4) as lx2, round((y2 + (s - height) / 2.0) * 416 / s, 4) as ly2, round(x1 + 0.0e0, 3) as ux1, round(y2 + 0.0e0, 3) as uy2
  from (select *, cast(greatest(width, height) as double) as s from {IMAGED})""")
def d7(spark, d):
    out = geo.unletterbox(geo.letterbox(imaged(box(spark, d))))
    return out.select(G, "idx", *(F.round(c, 4).alias(c) for c in ("lx1", "ly1", "lx2", "ly2")), F.round("ux1", 3).alias("ux1"), F.round("uy2", 3).alias("uy2"))


@query("d8_clamp", f"""{BOX} select figure_id, idx, {XY} from (select figure_id, idx, least(greatest(x1, 0), width) as x1, least(greatest(y1, 0), height) as y1,
  least(greatest(x2, 0), width) as x2, least(greatest(y2, 0), height) as y2 from {IMAGED}) where x2 - x1 > 5 and y2 - y1 > 5""")
def d8(spark, d):
    return geo.clamp(imaged(box(spark, d))).select(G, "idx", "x1", "y1", "x2", "y2")


@query("d9_crop")
def d9(spark, d):
    """Images made from the figures' ids; crops keep the box's size within the image."""
    b = imaged(box(spark, d))
    images = b.groupBy(G).agg(F.min("width").alias("width"), F.min("height").alias("height"), F.lit(1).alias("channels")).withColumn("data", F.repeat(F.char(F.lit(65) + F.col(G) % 26), F.col("width") * F.col("height")).cast("binary"))
    return geo.crop(images, geo.clamp(b).select(G, F.col("idx").cast("int").alias("idx"), "x1", "y1", "x2", "y2")).select(G, "idx", "width", "height", F.sha2("data", 256).alias("sha256"))


@query("e1_min_confidence", f"{BOX} select figure_id, idx, confidence from box where confidence > 0.5")
def e1(spark, d):
    return det.min_confidence(box(spark, d), 0.5).select(G, "idx", "confidence")


def _nms(clash: str, limit: str = "") -> str:
    return f"""{BOX}, l as (select figure_id, list([{{'r': -confidence, 'i': idx, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] order by -confidence, idx) as l from box group by figure_id),
k as (select figure_id, list_reduce(l, lambda a, x: case when len(list_filter(a, lambda k: {clash})) > 0 then a else list_concat(a, x) end) as k from l)
select figure_id, u.i as idx, -u.r as confidence from (select figure_id, unnest(k{limit}) as u from k)"""


_W, _H = "(least(k.x2, x[1].x2) - greatest(k.x1, x[1].x1){p})", "(least(k.y2, x[1].y2) - greatest(k.y1, x[1].y1){p})"
_BOTH = lambda p: f"cast(greatest({_W.format(p=p)}, 0) * greatest({_H.format(p=p)}, 0) as double)"


@query("e2_nms_overlap", _nms(f"{_BOTH(' + 1')} / ((x[1].x2 - x[1].x1 + 1) * (x[1].y2 - x[1].y1 + 1)) > 0.4"))
def e2(spark, d):
    return det.nms_overlap(box(spark, d), G, 0.4).select(G, "idx", "confidence")


@query("e3_nms_iou", _nms(f"{_BOTH('')} / ((x[1].x2 - x[1].x1) * (x[1].y2 - x[1].y1) + (k.x2 - k.x1) * (k.y2 - k.y1) - {_BOTH('')}) >= 0.2", "[1:4]"))
def e3(spark, d):
    return det.nms_iou(box(spark, d), G, 0.2, limit=4).select(G, "idx", "confidence")


LABELLED = "(select *, substr('aabbczz', cast(idx as int), 1) as label from box)"


def labelled(df):
    return df.withColumn("label", F.substring(F.lit("aabbczz"), F.col("idx").cast("int"), F.lit(1)))


@query("e4_best_per_label", f"""{BOX} select figure_id, label, idx, confidence from (select *, row_number() over (partition by figure_id, label order by confidence desc, idx) as r from {LABELLED}) where r = 1""")
def e4(spark, d):
    return det.best_per_label(labelled(box(spark, d)), G).select(G, "label", "idx", "confidence")


@query("e5_plausible_labels", f"""{BOX}, l as (select *, substr('addgbzz', cast(idx as int), 1) as label from box), n as (select figure_id, count(distinct label) as n from l where label <> 'z' group by figure_id)
  select figure_id, idx, label from l join n using (figure_id) where label <> 'z' and ascii(label) - ascii('a') < n + 2 and x2 - x1 < 64 and y2 - y1 < 64""")
def e5(spark, d):
    b = box(spark, d).withColumn("label", F.substring(F.lit("addgbzz"), F.col("idx").cast("int"), F.lit(1)))
    return det.plausible_labels(b, G).select(G, "idx", "label")


@query("e6_classify", """select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as class_index,
  round(1 / list_sum(list_transform(embedding, lambda x: exp(cast(x as double) - cast(list_max(embedding) as double)))), 4) as class_confidence from embeddings""")
def e6(spark, d):
    return det.classify(given(spark, d, "embeddings"), "embedding").select("vec_id", "class_index", "class_confidence")


@query("e7_fallback_full", f"""{BOX}, f as (select distinct figure_id, width, height from {IMAGED}), l as (select figure_id, cast(idx as varchar) as label, {XY} from box where kind = 0 and confidence > 0.6)
  select figure_id, coalesce(label, '0') as label, coalesce(x1, 0) as x1, coalesce(y1, 0) as y1, coalesce(x2, width) as x2, coalesce(y2, height) as y2 from f left join l using (figure_id)""")
def e7(spark, d):
    b = imaged(box(spark, d))
    found = b.where("kind = 0 and confidence > 0.6").withColumn("label", F.col("idx").cast("string"))
    return det.fallback_full(b.select(G, "width", "height").distinct(), found, G)


@query("e8_score")
def e8(spark, d):
    """A stand-in model: one box a figure over the middle of its image."""

    def make_predict():
        def predict(pdf):
            return pdf.assign(x1=pdf.width // 4, y1=pdf.height // 4, x2=pdf.width * 3 // 4, y2=pdf.height * 3 // 4, confidence=0.9)[["figure_id", "x1", "y1", "x2", "y2", "confidence"]]

        return predict

    images = imaged(box(spark, d)).select(G, "width", "height").distinct()
    return det.score(images, make_predict, "figure_id long, x1 int, y1 int, x2 int, y2 int, confidence double")


SUB = ctes("sub")


@query("e9_subfigure_records", f"""{SUB} select figure_id, count(*) as n, string_agg(concat(label, ':', classification, ':', y2 - y1, 'x', x2 - x1), ',' order by idx) as records from sub group by figure_id""")
def e9(spark, d):
    rec = det.subfigure_records(derived(spark, d, "sub"), G)
    text = F.transform("master_images", lambda m: F.concat(m["subfigure_label"]["text"], F.lit(":"), m["classification"], F.lit(":"), m["height"].cast("string"), F.lit("x"), m["width"].cast("string")))
    return rec.select(G, F.size("master_images").cast("long").alias("n"), F.array_join(text, ",").alias("records"))


LBL = ctes("lbl")
_NUM = r"regexp_extract(text, '^\s*([0-9]*\.?[0-9]+)\s*[A-Za-z]+\s*$', 1)"
_UNIT = r"(case lower(regexp_extract(text, '^\s*[0-9]*\.?[0-9]+\s*([A-Za-z]+)\s*$', 1)) when 'n' then 'nm' when 'c' then 'cm' when 'u' then 'um' else lower(regexp_extract(text, '^\s*[0-9]*\.?[0-9]+\s*([A-Za-z]+)\s*$', 1)) end)"
_L = f"{LBL}, p as (select *, {_NUM} as num, {_UNIT} as unit from lbl), v as (select *, num <> '' and unit in ('nm', 'mm', 'cm', 'um', 'a') as ok from p)"
_NM = "case unit when 'a' then 0.1e0 when 'nm' then 1e0 when 'um' then 1e3 when 'mm' then 1e6 when 'cm' then 1e7 when 'm' then 1e9 end"


def lbl(spark, d):
    return derived(spark, d, "lbl")


@query("f1_first_valid", f"""{_L} select figure_id, coalesce(min_by(num || ' ' || unit, idx) filter (ok), '-1') as reading from v group by figure_id""")
def f1(spark, d):
    return scale.first_valid(lbl(spark, d).withColumn("rank", F.col("idx")), G)


@query("f2_decode_indices", f"{LBL} select figure_id, idx, text from lbl")
def f2(spark, d):
    table = [*scale.CLASSES, "p", "x"]
    known = F.transform(F.split("text", ""), lambda c: F.array_position(F.array(*map(F.lit, table)), c) - 1)
    blanks = F.concat(known, F.array(F.lit(len(table)).cast("long")))
    return lbl(spark, d).select(G, "idx", scale.decode_indices(blanks, table).alias("text"))


@query("f3_split_label", f"{_L} select figure_id, idx, try_cast(nullif(num, '') as double) as number, nullif(unit, '') as unit from v")
def f3(spark, d):
    return scale.split_label(lbl(spark, d)).select(G, "idx", "number", "unit")


@query("f4_valid_label", f"{_L} select figure_id, idx, ok as valid from v")
def f4(spark, d):
    return lbl(spark, d).select(G, "idx", scale.is_valid_label(F.col("text")).alias("valid"))


@query("f5_to_nm", f"{_L} select figure_id, idx, trunc(try_cast(nullif(num, '') as double) * ({_NM}) * 100) / 100.0 as nm from v")
def f5(spark, d):
    return scale.to_nm(lbl(spark, d)).select(G, "idx", "nm")


@query("f6_split_objects", f"{BOX} select figure_id, idx, kind, case when kind = 1 then x2 - x1 end as length from box where kind in (1, 2)")
def f6(spark, d):
    lines, labels = scale.split_objects(box(spark, d))
    return lines.select(G, "idx", "kind", "length").union(labels.select(G, "idx", "kind", F.lit(None).cast("int")))


_NEAR = f"""{BOX}, c as (select l.figure_id, l.idx as line_idx, b.idx as label_idx, pow((l.x1 + l.x2 - b.x1 - b.x2) / 2.0, 2) + pow((l.y1 + l.y2 - b.y1 - b.y2) / 2.0, 2) as d
  from box l join box b using (figure_id) where l.kind = 1 and b.kind = 2),
m as (select * from (select *, row_number() over (partition by figure_id, line_idx order by d, label_idx) as r from c where d <= 5000) where r = 1)"""


def near(spark, d):
    lines, labels = scale.split_objects(box(spark, d))
    return lines, labels, scale.nearest_label(lines, labels, G)


@query("f7_nearest_label", f"{_NEAR} select b.figure_id, b.idx as line_idx, m.label_idx, cast(coalesce(m.d, -1) as double) as distance from box b left join m on m.figure_id = b.figure_id and m.line_idx = b.idx where b.kind = 1")
def f7(spark, d):
    return near(spark, d)[2].select(G, "line_idx", "label_idx", "distance")


@query("f8_unmatched_labels", f"{_NEAR} select figure_id, idx from box where kind = 2 and (figure_id, idx) not in (select (figure_id, label_idx) from m)")
def f8(spark, d):
    _, labels, matched = near(spark, d)
    return scale.unmatched_labels(labels, matched, G).select(G, "idx")


_ASSIGN = f"""{BOX}, a as (select i.figure_id, i.idx as in_idx, min(o.idx) as subfigure_idx from box i join box o using (figure_id)
  where i.kind <> 0 and o.kind = 0 and i.x1 > o.x1 and i.y1 > o.y1 and i.x2 < o.x2 and i.y2 < o.y2 group by all)"""


def assigned(spark, d):
    b = box(spark, d)
    return b.where("kind != 0"), b.where("kind = 0"), scale.assign_to_subfigure(b.where("kind != 0"), b.where("kind = 0"), G)


@query("f9_assign", f"{_ASSIGN} select figure_id, in_idx, subfigure_idx from a")
def f9(spark, d):
    return assigned(spark, d)[2]


@query("f10_physical_size", f"""{_ASSIGN}, n as (select a.figure_id, a.subfigure_idx as idx, a.in_idx as line_idx, (b.x2 - b.x1) as length, cast(b.idx % 2 + 1 as double) * 50 as nm from a join box b on b.figure_id = a.figure_id and b.idx = a.in_idx where b.kind = 1),
  r as (select figure_id, idx, max_by(nm / length, line_idx) as ratio from n where length > 0 group by all having count(distinct nm) = 1)
  select s.figure_id, s.idx, trunc(ratio * (x2 - x1) * 10) / 10.0 as nm_width, trunc(ratio * (y2 - y1) * 10) / 10.0 as nm_height from box s left join r on r.figure_id = s.figure_id and r.idx = s.idx where s.kind = 0""")
def f10(spark, d):
    objects, subfigures, found = assigned(spark, d)
    bars = objects.where("kind = 1").join(found.withColumnRenamed("in_idx", "idx"), [G, "idx"])
    bars = bars.select(G, "subfigure_idx", F.col("idx").alias("line_idx"), (F.col("x2") - F.col("x1")).alias("length"), ((F.col("idx") % 2 + 1).cast("double") * 50).alias("nm"))
    return scale.physical_size(subfigures, bars, G).select(G, "idx", "nm_width", "nm_height")


@query("f11_unassigned", f"{_ASSIGN} select figure_id, idx from box where kind <> 0 and (figure_id, idx) not in (select (figure_id, in_idx) from a)")
def f11(spark, d):
    objects, _, found = assigned(spark, d)
    return scale.unassigned(objects, found, G).select(G, "idx")


@query("f12_bigram_model", """with p as (select substr(text, i, 2) as pair from (select text, unnest(generate_series(1, length(text) - 1)) as i from documents)), n as (select pair, count(*) as n from p group by pair)
  select substr(pair, 1, 1) as first, substr(pair, 2, 1) as second, n, round(n / sum(n) over (partition by substr(pair, 1, 1)), 6) as p from n""")
def f12(spark, d):
    return scale.bigram_model(given(spark, d, "documents")).withColumn("p", F.round("p", 6))


@query("f13_word_list", r"""select word, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) as word from documents) where regexp_full_match(word, '\p{L}+') group by word""")
def f13(spark, d):
    return scale.word_list(given(spark, d, "documents"))


@query("f14_encode_label", f"""{LBL}, t as (select figure_id, idx, list_transform(list_filter(list_transform(string_split(text, ''), lambda c: list_position(['0','1','2','3','4','5','6','7','8','9','.',' ','a','c','m','n','u','A','C','M','N'], c)), lambda i: i > 0), lambda i: i - 1) as k from lbl)
  select figure_id, idx, list_aggregate(list_concat(k, list_transform(range(32), lambda i: 21))[1:32], 'string_agg', ',') as code from t""")
def f14(spark, d):
    return lbl(spark, d).select(G, "idx", F.array_join(scale.encode_label(F.col("text")).cast("array<string>"), ",").alias("code"))
