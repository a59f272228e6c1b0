"""Queries of caption joins, result tables and search over the derived figures."""

import uuid

from pyspark.sql import functions as F

from figloom.functions.session import materialise, shared_dir
from figloom.operators import scale, search, tables, trigrams
from figloom.plans.box_queries import _ASSIGN, _NEAR, assigned, lbl, near
from figloom.plans.fixtures import ctes, derived, given
from figloom.plans.registry import query

G = "figure_id"


def captions(spark, d):
    e = derived(spark, d, "ent")
    return e.select(G, "pos", "label", F.array("description").alias("caption"), F.array("keyword").alias("keywords"), F.array(F.lit("image")).alias("general"))


def joined(spark, d):
    return tables.assign_captions(derived(spark, d, "sub"), captions(spark, d), G)


def flat(spark, d):
    """figures, subfigures with captions, sizes, and bars; odd idx leave height and width to the box."""
    _, _, found = assigned(spark, d)
    _, _, matched = near(spark, d)
    read = scale.to_nm(lbl(spark, d)).select(G, F.col("idx").alias("label_idx"), "text", "label_confidence", "nm")
    bars = matched.join(found.select(G, F.col("in_idx").alias("line_idx"), "subfigure_idx"), [G, "line_idx"]).join(read, [G, "label_idx"], "left")
    bars = materialise(bars.withColumn("label", F.when(F.col("label_idx").isNotNull(), F.struct("text", "label_confidence", "nm"))))
    sub = scale.physical_size(joined(spark, d), bars, G)
    even = F.col("idx") % 2 == 0
    sub = sub.withColumn("height", F.when(even, (F.col("y2") - F.col("y1")).cast("double"))).withColumn("width", F.when(even, (F.col("x2") - F.col("x1")).cast("double")))
    sub = sub.withColumn("label_box", F.when(F.col("label") != "z", F.struct("x1", "y1", (F.col("x1") + 9).alias("x2"), (F.col("y1") + 9).alias("y2")))).withColumn("scale_label", F.when(F.col("nm_width").isNotNull(), F.concat(F.col("nm_width").cast("int").cast("string"), F.lit(" nm"))))
    head = sub.groupBy(G).agg(F.min("article_id").alias("article_id"), F.min("title").alias("title"), F.min("open").alias("open")).join(derived(spark, d, "cap"), G)
    name = F.concat(F.col("article_id").cast("string"), F.lit("_fig"), F.col(G).cast("string"), F.lit(".jpg"))
    head = head.select(G, F.col("article_id").cast("string").alias("article_name"), "title", "open", name.alias("figure_name"), F.col("caption").alias("full_caption"), F.lit("alpha").alias("caption_delimiter"), F.concat(F.lit("https://example.org/articles/"), F.col("article_id").cast("string")).alias("article_url"), F.lit("unknown").alias("license"), F.concat(F.lit("https://img.example.org/"), name).alias("image_url"), F.concat(F.lit("figures/"), name).alias("figure_path"))
    return head, sub.drop("title", "open", "article_id", "ratio"), bars


def figures(spark, d):
    """The nested figures."""
    return tables.group_objects(*flat(spark, d), G)


_BARS = f"""{_ASSIGN}, {ctes("lbl", "ent", "sub", "cap").removeprefix("with ").replace(ctes("box").removeprefix("with ") + ",", "")}, {_NEAR.split("group by l_orderkey, l_linenumber),", 1)[1]},
read as (select figure_id, idx, text, label_confidence, trunc(try_cast(nullif(regexp_extract(text, '^([0-9.]+) ', 1), '') as double) *
  (case lower(regexp_extract(text, ' ([A-Za-z]+)$', 1)) when 'a' then 0.1e0 when 'nm' then 1e0 when 'n' then 1e0 when 'um' then 1e3 when 'mm' then 1e6 end) * 100) / 100.0 as nm from lbl),
bar as (select a.figure_id, a.subfigure_idx, l.idx as line_idx, row_number() over (partition by a.figure_id, a.subfigure_idx order by l.idx) - 1 as i, l.x1, l.y1, l.x2, l.y2, l.x2 - l.x1 as length,
  cast(coalesce(m.d, -1) as double) as distance, l.confidence, m.label_idx, r.text, r.label_confidence, r.nm
  from a join box l on l.figure_id = a.figure_id and l.idx = a.in_idx and l.kind = 1 left join m on m.figure_id = l.figure_id and m.line_idx = l.idx left join read r on r.figure_id = l.figure_id and r.idx = m.label_idx),
ratio as (select figure_id, subfigure_idx as idx, max_by(nm / length, line_idx) as ratio from bar where length > 0 and nm is not null group by all having count(distinct nm) = 1),
cl as (select figure_id, pos, lower(translate(label, '().', '')) as l, description, keyword, row_number() over (partition by figure_id, lower(translate(label, '().', '')) order by pos) as n from ent),
sl as (select *, lower(translate(label, '().', '')) as l, row_number() over (partition by figure_id, lower(translate(label, '().', '')) order by idx) as n from sub),
j as (select sl.*, cl.pos, cl.description, cl.keyword, trunc(ratio * (x2 - x1) * 10) / 10.0 as nm_width, trunc(ratio * (y2 - y1) * 10) / 10.0 as nm_height,
  concat(cast(article_id as varchar), '-fig', cast(sl.figure_id as varchar)) as fid, concat(cast(article_id as varchar), '-fig', cast(sl.figure_id as varchar), '-', label) as sid
  from sl left join cl using (figure_id, l, n) left join ratio using (figure_id, idx)),
article as (select cast(article_id as varchar) as doi, min_by(title, fid) as title, concat('https://example.org/articles/', cast(article_id as varchar)) as url, 'unknown' as license, min_by(open, fid) as open, '' as authors, '' as abstract from j group by article_id),
figure as (select fid as figure_id, caption, 'alpha' as caption_delimiter, concat('https://img.example.org/', n) as url, concat('figures/', n) as path, cast(a as varchar) as article_id
  from (select distinct figure_id, fid, article_id as a, concat(cast(article_id as varchar), '_fig', cast(figure_id as varchar), '.jpg') as n from j) join cap using (figure_id)),
subfigure as (select sid as subfigure_id, case classification when 'microscopy' then 'MC' when 'diffraction' then 'DF' when 'graph' then 'GR' when 'basic_photo' then 'PH' when 'illustration' then 'IL' when 'unclear' then 'UN' when 'parent' then 'PT' end as classification_code,
  cast(y2 - y1 as double) as height, cast(x2 - x1 as double) as width, nm_height, nm_width, x1, y1, x2, y2, coalesce(description, '') as caption,
  case when keyword is null then '{{}}' else concat('{{''', keyword, '''}}') end as keywords, case when keyword is null then '{{}}' else '{{''image''}}' end as general, fid as figure_id from j),
scalebar as (select concat(sid, '-', cast(i as varchar)) as scale_bar_id, bar.x1, bar.y1, bar.x2, bar.y2, length, distance as line_label_distance, bar.confidence, sid as subfigure_id, label_idx, text, label_confidence, nm
  from bar join j on j.figure_id = bar.figure_id and j.idx = bar.subfigure_idx)""".replace("{{}}", "{}").replace("{{''", "{''").replace("''}}", "''}")
_T = "subfigure_id, classification_code, height, width, nm_height, nm_width, x1, y1, x2, y2, caption, keywords, general, figure_id"


@query("g1_assign_captions", f"{_BARS} select figure_id, idx, label, coalesce(description, '') as caption, coalesce(keyword, '') as keywords from j")
def g1(spark, d):
    return joined(spark, d).select(G, "idx", "label", F.array_join("caption", "|").alias("caption"), F.array_join("keywords", "|").alias("keywords"))


@query("g2_unassigned_captions", f"{_BARS} select figure_id, pos from cl where figure_id in (select figure_id from sub) and not exists (select 1 from sl where sl.figure_id = cl.figure_id and sl.l = cl.l and sl.n = cl.n)")
def g2(spark, d):
    sub = derived(spark, d, "sub")
    return tables.unassigned_captions(sub, captions(spark, d).join(sub.select(G).distinct(), G, "left_semi"), G).select(G, "pos")


@query("g3_group_objects", f"""{_BARS} select j.figure_id, count(*) as n_subfigures, cast(coalesce(sum(b.n), 0) as bigint) as n_bars, string_agg(label, ',' order by idx) as labels
  from j left join (select figure_id, subfigure_idx as idx, count(*) as n from bar group by all) b using (figure_id, idx) group by j.figure_id""")
def g3(spark, d):
    bars = F.aggregate("master_images", F.lit(0), lambda a, m: a + F.size(m["scale_bars"]))
    return figures(spark, d).select(G, F.size("master_images").cast("long").alias("n_subfigures"), bars.cast("long").alias("n_bars"), F.array_join(F.transform("master_images", lambda m: m["label"]), ",").alias("labels"))


@query("g4_article_table", f"{_BARS} select * from article")
def g4(spark, d):
    return tables.article_table(flat(spark, d)[0])


@query("g5_figure_table", f"{_BARS} select * from figure")
def g5(spark, d):
    return tables.figure_table(flat(spark, d)[0])


@query("g6_subfigure_table", f"{_BARS} select {_T} from subfigure")
def g6(spark, d):
    head, sub, _ = flat(spark, d)
    return tables.subfigure_table(tables.images_of(head, sub, G))


@query("g7_subfigure_label_table", f"{_BARS} select label as text, x1, y1, x1 + 9 as x2, y1 + 9 as y2, sid as subfigure_id from j where label <> 'z'")
def g7(spark, d):
    return tables.subfigure_label_table(figures(spark, d))


@query("g8_scale_bar_table", f"{_BARS} select scale_bar_id, x1, y1, x2, y2, length, line_label_distance, confidence, subfigure_id from scalebar")
def g8(spark, d):
    return tables.scale_bar_table(figures(spark, d))


@query("g9_scale_label_table", f"{_BARS} select text, label_confidence, nm, scale_bar_id from scalebar where label_idx is not null")
def g9(spark, d):
    return tables.scale_label_table(figures(spark, d))


@query("g10_class_code", f"{_BARS} select classification_code, count(*) as n from subfigure group by all")
def g10(spark, d):
    return derived(spark, d, "sub").groupBy(tables.class_code(F.col("classification")).alias("classification_code")).agg(F.count("*").alias("n"))


@query("g11_keys", f"{_BARS} select distinct figure_id, fid as figure_key from j")
def g11(spark, d):
    return figures(spark, d).select(G, tables.figure_key(F.col("figure_name")).alias("figure_key"))


@query("g12_pg_array", f"{_BARS} select figure_id, concat('{{', string_agg(concat('''', keyword, ''''), ', ' order by pos), '}}') as literal from ent group by figure_id".replace("{{", "{").replace("}}", "}"))
def g12(spark, d):
    e = derived(spark, d, "ent").groupBy(G).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "keyword"))), lambda x: x["keyword"]).alias("k"))
    return e.select(G, tables.pg_array(F.col("k")).alias("literal"))


@query("g13_backfill_size", f"{_BARS} select subfigure_id, height, width from subfigure")
def g13(spark, d):
    return tables.subfigure_table(figures(spark, d)).select("subfigure_id", "height", "width")


@query("g14_figure_card", f"""{_BARS} select fid as figure_id, cast(sum(y2 - y1 + 150) as double) as height, cast(greatest(max(x2 - x1), 500) as double) as width,
  string_agg(concat('Subfigure Label: ', label, chr(10), 'Classification: ', classification, chr(10), 'Scale Bar Label: ', case when nm_width is null then 'None' else concat(cast(cast(trunc(nm_width) as int) as varchar), ' nm') end, chr(10), 'Caption:', chr(10), coalesce(description, '')), chr(10) || chr(10) order by idx) as card from j group by fid""")
def g14(spark, d):
    return tables.figure_card(figures(spark, d))


@query("g15_overlay_boxes", f"""{_BARS} select fid as figure_id, 'subfigure' as kind, x1, y1, x2, y2 from j union all select regexp_replace(subfigure_id, '-[^-]*$', ''), 'scale_bar', x1, y1, x2, y2 from scalebar
  union all select cast(figure_id as varchar), 'unassigned', x1, y1, x2, y2 from box where kind <> 0 and (figure_id, idx) not in (select (figure_id, in_idx) from a)""")
def g15(spark, d):
    objects, _, found = assigned(spark, d)
    loose = scale.unassigned(objects, found, G).withColumn(G, F.col(G).cast("string"))
    return tables.overlay_boxes(figures(spark, d), loose)


@query("g16_crop_manifest", f"""{_BARS}, b as (select concat(cast(figure_id as varchar), '/', label) as dir, concat(cast(figure_id as varchar), '_', label) as stem, lower(left(case when idx = 3 then null else classification end, 3)) as c, idx from sub)
  select dir, concat(stem, '_', coalesce(c, 'uas'), '.jpg') as file from b union all select dir || '/dependent', stem || '_dep0_gra.jpg' from b
  union all select dir || '/dependent/inset', stem || '_dep0_ins0_uas.jpg' from b union all select dir || '/inset', concat(stem, '_ins', cast(k as varchar), '_mic.jpg') from b, (values (0), (1)) v(k)""")
def g16(spark, d):
    kind = F.when(F.col("idx") == 3, F.lit(None)).otherwise(F.col("classification"))
    inset = "array<struct<classification:string>>"
    images = derived(spark, d, "sub").select(F.col(G).cast("string").alias("figure_root"), "label", kind.alias("classification"), F.array(F.struct(F.lit("graph").alias("classification"), F.array(F.struct(F.lit(None).cast("string").alias("classification"))).cast(inset).alias("insets"))).alias("dependents"), F.array_repeat(F.struct(F.lit("microscopy").alias("classification")), 2).alias("insets"))
    return tables.crop_manifest(images)


def result_tables(spark, d):
    head, sub, bars = flat(spark, d)
    images, lines = tables.images_of(head, sub, G), tables.bars_of(head, sub, bars, G)
    return search.Tables(tables.article_table(head), tables.figure_table(head), tables.subfigure_table(images), tables.scale_bar_table(lines), tables.scale_label_table(lines))


@query("h1_by_class", f"{_BARS} select subfigure_id from subfigure where classification_code in ('MC', 'GR')")
def h1(spark, d):
    return search.by_class(result_tables(spark, d).subfigure, ["MC", "GR"]).select("subfigure_id")


@query("h2_by_open", f"{_BARS} select subfigure_id from subfigure join figure f using (figure_id) join article on doi = f.article_id where open")
def h2(spark, d):
    t = result_tables(spark, d)
    return search.by_open(t.subfigure, t.figure, t.article, True).select("subfigure_id")


@query("h3_by_scale", f"{_BARS} select subfigure_id, nm_width from subfigure where nm_width >= 50 and nm_width < 1e6")
def h3(spark, d):
    return search.by_scale(result_tables(spark, d).subfigure, 50, 1e6).select("subfigure_id", "nm_width")


@query("h4_by_scale_confidence", f"{_BARS} select subfigure_id from subfigure where subfigure_id in (select subfigure_id from scalebar where label_confidence > 0.3)")
def h4(spark, d):
    t = result_tables(spark, d)
    return search.by_scale_confidence(t.subfigure, t.scale_bar, t.scale_label, 0.3).select("subfigure_id")


_KEY = "(contains(lower(s.caption), 'economy') or contains(lower(f.caption), 'economy') or contains(lower(title), 'economy') or contains(lower(s.caption), 'blue') or contains(lower(f.caption), 'blue') or contains(lower(title), 'blue'))"


@query("h5_by_keyword", f"{_BARS} select subfigure_id from subfigure s join figure f using (figure_id) join article on doi = f.article_id where {_KEY}")
def h5(spark, d):
    t = result_tables(spark, d)
    return search.by_keyword(t.subfigure, t.figure, t.article, ["Economy", "blue"], ["caption", "full_caption", "title"]).select("subfigure_id")


@query("h6_search", f"""{_BARS} select subfigure_id, classification_code, nm_width, s.caption from subfigure s join figure f using (figure_id) join article on doi = f.article_id
  where classification_code in ('MC', 'DF', 'GR', 'PH', 'IL') and nm_width >= 1 and nm_width < 1e9 and {_KEY} and subfigure_id in (select subfigure_id from scalebar where label_confidence > 0.1)""")
def h6(spark, d):
    p = search.Params(classes=["MC", "DF", "GR", "PH", "IL"], min_scale=1, max_scale=1e9, confidence=0.1, keywords=["economy", "BLUE"])
    return search.search(result_tables(spark, d), p).select("subfigure_id", "classification_code", "nm_width", "caption")


def stored_tables(spark, d):
    """The result tables, written once: what a search by keyword reads of them; those of scales it doesn't read stay as they are."""
    t = result_tables(spark, d)
    read = (t.article.select("doi", "title"), t.figure.select("figure_id", "article_id", "caption"), t.subfigure.select("subfigure_id", "figure_id", "caption"))
    return search.Tables(*(materialise(x) for x in read), t.scale_bar, t.scale_label)


@query("h5_indexed_keyword", f"{_BARS} select subfigure_id from subfigure s join figure f using (figure_id) join article on doi = f.article_id where {_KEY}")
def h5i(spark, d):
    t = stored_tables(spark, d)
    indexes = search.index_tables(t, f"{shared_dir(spark)}/index-{uuid.uuid4().hex}", 16)
    return search.by_indexed_keyword(t.subfigure, t.figure, ["Economy", "blue"], ["caption", "full_caption", "title"], indexes).select("subfigure_id")


@query("h5_caption_pieces", f"""{_BARS}, k as (select distinct concat(substr(p_type, 2), ' image') as piece from part)
  select distinct caption_id, piece from (select figure_id as caption_id, caption from cap) c join k on contains(lower(caption), lower(piece))""")
def h5p(spark, d):
    caps = derived(spark, d, "cap").select(F.col(G).alias("caption_id"), "caption")
    index = trigrams.build(caps, "caption_id", "caption", f"{shared_dir(spark)}/index-{uuid.uuid4().hex}", 16)
    pieces = [r[0] for r in given(spark, d, "part").select(F.concat(F.expr("substr(p_type, 2)"), F.lit(" image"))).distinct().collect()]
    return index.holding_each(pieces).select(F.col("id").alias("caption_id"), "piece")


@query("h7_page", f"{_BARS} select s.sid as subfigure_id, p.n, p.pages from (select sid from j order by sid limit 20 offset 40) s, (select count(*) as n, cast(ceil(count(*) / 20.0) as bigint) as pages from j) p")
def h7(spark, d):
    s = result_tables(spark, d).subfigure.select("subfigure_id")
    return search.page_of(s, "subfigure_id", 20, 3).join(F.broadcast(search.page_count(s, 20)))


@query("h8_grid_columns", f"{_BARS} select sid as subfigure_id, cast((row_number() over (order by sid) - 1) % 3 as int) as grid_column from (select sid from j order by sid limit 30)")
def h8(spark, d):
    s = result_tables(spark, d).subfigure.select("subfigure_id")
    return search.grid_columns(search.page_of(s, "subfigure_id", 30, 1), "subfigure_id", 3)


@query("h9_detail_view", f"{_BARS} select subfigure_id, f.url as image_url, f.article_id, title, a.url as article_url, license, open from subfigure join figure f using (figure_id) join article a on doi = f.article_id")
def h9(spark, d):
    t = result_tables(spark, d)
    return search.detail_view(t.subfigure, t.figure, t.article).select("subfigure_id", "image_url", "article_id", "title", "article_url", "license", "open")
