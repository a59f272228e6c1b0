"""Queries of page extraction, on the given pages and on pages made of captions."""

from pyspark.sql import functions as F

from figloom.operators import html as hp
from figloom.operators import pages as pg
from figloom.plans.fixtures import ctes, derived, given
from figloom.plans.registry import query

HTML = ctes("html")
FAM = ctes("fam")
_LINKS = """l as (select page_id, string_split(link, '?page=search')[1] as link from (select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as link from pages))"""


def html(spark, d):
    return derived(spark, d, "html").withColumnRenamed("figure_id", "page_id")


def family_pages(spark, d, family):
    return derived(spark, d, "fam").select(F.col("figure_id").alias("page_id"), F.col(family).alias("html"))


def families(spark):
    return spark.createDataFrame(pg.FAMILIES, pg.FAMILY_SCHEMA)


@query("b1_expand_terms", "select distinct p_type as term, r_name as place from part, region")
def b1(spark, d):
    return pg.expand_terms([given(spark, d, "part").select(F.col("p_type").alias("term")).distinct(), given(spark, d, "region").select(F.col("r_name").alias("place"))])


_TEMPLATE = """(values ('acs', 'https://pubs.acs.org/action/doSearch?AllField="', '"+"', '"&publication=&accessType=allContent&Earliest=&pageSize=20&startPage=0&sortBy=', '"&publication=&openAccess=18&accessType=openAccess&Earliest=&pageSize=20&startPage=0&sortBy=', ''),
  ('nature', 'https://www.nature.com/search?q="', '"%20"', '"&order=', '"&order=', '&page=1'),
  ('rsc', 'https://pubs.rsc.org/en/results?searchtext=', '"%20"', '"&SortBy=', '"&SortBy=', '&PageSize=1&tab=all&fcategory=all&filter=all&Article%20Access=Open+Access')) f(family, head, j, s, o, tail)"""


@query("b2_search_urls", f"""select distinct f.family, only_open, concat(head, replace(p_name, ' ', '+'), j, replace(p_type, ' ', '+'), case when only_open then o else s end, 'date', tail) as url
  from part, {_TEMPLATE}, (values (true), (false)) w(only_open)""")
def b2(spark, d):
    terms = given(spark, d, "part").select("p_name", "p_type").distinct().crossJoin(F.broadcast(families(spark).select("family")))
    made = [pg.search_urls(terms, families(spark), ["p_name", "p_type"], "date", w).select("family", F.lit(w).alias("only_open"), "url") for w in (True, False)]
    return made[0].union(made[1]).distinct()


@query("b3_paginate", f"""with u as (select page_id, family, concat(head, 'x', s, 'date', tail) as url, page_id % 4 + 1 as last, page_id % 90 as n from pages, {_TEMPLATE}),
  p as (select *, unnest(generate_series(1, case when family = 'rsc' then 1 else last end)) as p from u)
  select page_id, family, cast(p as bigint) as page, case family when 'nature' then concat(string_split(url, '&page=')[1], '&page=', cast(p as varchar)) when 'acs' then concat(string_split(url, '&startPage=')[1], '&startPage=', cast(p as varchar), '&pageSize=20')
  else concat(string_split(url, '1&tab=all')[1], cast(n as varchar), '&tab=all&fcategory=all&filter=all&Article%20Access=Open+Access') end as page_url from p""")
def b3(spark, d):
    terms = given(spark, d, "pages").select("page_id", F.lit("x").alias("term")).crossJoin(F.broadcast(families(spark).select("family")))
    last = F.when(F.col("family") == "rsc", F.lit(1)).otherwise(F.col("page_id") % 4 + 1).cast("long")
    urls = pg.search_urls(terms, families(spark), ["term"], "date").withColumns({"first": F.lit(1).cast("long"), "last": last})
    return pg.paginate(urls, F.col("family"), F.col("page_id") % 90).select("page_id", "family", "page", "page_url")


@query("b4_page_info", f"""{ctes("html", "fam")} select figure_id as page_id, 'nature' as family, 1 as page, cast(figure_id % 4 + 1 as int) as total_pages, 12 as total_results from html
  union all select figure_id, 'acs', 0, cast(ceil(figure_id % 300 / 20.0) as int) - 1, cast(figure_id % 300 as int) from fam union all select figure_id, 'rsc', 1, 1, cast(case when figure_id % 4 = 0 then 0 else figure_id % 500 end as int) from fam""")
def b4(spark, d):
    pages = {"nature": html(spark, d), "acs": family_pages(spark, d, "acs"), "rsc": family_pages(spark, d, "rsc")}
    told = [p.select("page_id", F.lit(k).alias("family"), *(c.alias(n) for n, c in pg.page_info(F.col("html"), k).items())) for k, p in pages.items()]
    return told[0].union(told[1]).union(told[2])


@query("b5_data_layer", HTML + r" select figure_id as page_id, regexp_extract(html, '\[(\{.*?\})\];', 1) as json from html")
def b5(spark, d):
    return html(spark, d).select("page_id", pg.data_layer(F.col("html")).alias("json"))


@query("b6_article_links", f"with {_LINKS} select page_id, link from l where contains(link, '/th')")
def b6(spark, d):
    return pg.article_links(given(spark, d, "pages"), "/th")


@query("b7_drop_reader_links", f"with {_LINKS} select page_id, link from l where contains(link, '/') and not list_has_any(string_split(link, '/'), ['fr', 'de'])")
def b7(spark, d):
    return pg.drop_reader_links(pg.article_links(given(spark, d, "pages"), "/"), ["fr", "de"])


@query("b8_unvisited", f"with {_LINKS} select page_id, string_split(link, '/')[-1] as key, link from l where contains(link, '/') and string_split(link, '/')[-1] not in (select string_split(url, '/')[-1] from pages where url is not null)")
def b8(spark, d):
    ledger = given(spark, d, "pages").where("url is not null").select(pg.last_segment(F.col("url")).alias("key"))
    return pg.unvisited(pg.article_links(given(spark, d, "pages"), "/"), ledger).select("page_id", "key", "link")


@query("b9_open_links", f"{HTML} select figure_id as page_id, concat('/articles/', cast(figure_id as varchar)) as link from html where figure_id % 3 <> 0 union all select figure_id, concat('/articles/full/', cast(figure_id as varchar)) from html")
def b9(spark, d):
    return pg.open_links(html(spark, d))


@query("b10_cap_links", f"with {_LINKS} select distinct link from l where contains(link, '/th') order by link limit 50")
def b10(spark, d):
    return pg.cap_links(pg.article_links(given(spark, d, "pages"), "/th"), 50)


@query("b11_license", f"""{ctes("html", "fam")} select figure_id as page_id, 'nature' as family, figure_id % 2 = 0 as open, 'unknown' as license from html
  union all select figure_id, 'acs', figure_id % 3 <> 2, case figure_id % 3 when 0 then 'ACS AuthorChoice ' || cast(figure_id as varchar) when 1 then 'ACS Editors'' Choice ' || cast(figure_id as varchar) else 'unknown' end from fam""")
def b11(spark, d):
    told = [p.select("page_id", F.lit(k).alias("family"), *(c.alias(n) for n, c in pg.license_info(F.col("html"), k).items())) for k, p in (("nature", html(spark, d)), ("acs", family_pages(spark, d, "acs")))]
    return told[0].union(told[1])


# Every fourth page has a figure within a figure; RSC's block has divs of its own.
_WIDE = """concat('<figure class="wide"><div>', inner_, '</div><p>Outer &amp; last</p></figure>')"""
_BLOCKS = f"""{ctes("html", "fam")}, i as (select figure_id, caption, cast(figure_id as varchar) as n, concat('<figure><img src="//img.example.org/', figure_id, '_b.jpg"><p>Inner</p></figure>') as inner_ from cap),
  b as (select figure_id, 'nature' as family, [concat('<figure><img src="//img.example.org/', n, '_hi-res.jpg"><p>', caption, '</p></figure>')] || case when figure_id % 4 = 1 then [{_WIDE}, inner_] else [] end || ['<figure><p></p></figure>'] as b from i
  union all select figure_id, 'rsc', [concat('<div class="image_table"><a href="/image/article/', n, '/small.gif">s</a><a href="/image/article/', n, '/large_hi-res.gif"><b>l</b></a><a href="/other">o</a><div class="inner"><div>pad</div></div><span class="graphic_title"><b>Fig. 1</b> ', caption, '</span></div>'),
    '<div class="image_table"><a href="/x/image/article/y">x</a></div>'] from i)"""


@query("b12_figure_blocks", f"{_BLOCKS} select figure_id as page_id, family, cast(p as int) as pos, b[p + 1] as block from (select *, unnest(range(len(b))) as p from b)")
def b12(spark, d):
    found = [pg.figure_blocks(p, "page_id", k).withColumn("family", F.lit(k)) for k, p in (("nature", html(spark, d)), ("rsc", family_pages(spark, d, "rsc")))]
    return found[0].union(found[1])


def rsc_captions(spark, d):
    return pg.captions(pg.figure_blocks(family_pages(spark, d, "rsc"), "page_id", "rsc"), "rsc")


# A paragraph ends at its end tag, at a block's start or at its parent's end; references of the given pages are resolved.
_PIECES = r"""list_transform(regexp_split_to_array(regexp_replace(html, '(?s)<(?:script|style|title)>.*?</(?:script|style|title)>|<!--.*?-->', '', 'g'), '<p(?:\s[^>]*)?>')[2:], lambda t: regexp_extract(t, '(?s)^(.*?)(?:</(?:p|article|body|html|div)>|<(?:footer|div|h1|nav|ul|article)[ >]|$)', 1))"""
_PLAIN = "replace(replace(replace(replace(regexp_replace(t, '<[^>]*>', '', 'g'), '&quot;', chr(34)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@query("b13_captions", f"""{FAM} select page_id, 'nature' as family, caption from (select page_id, coalesce(list_aggregate(list_transform({_PIECES}, lambda t: {_PLAIN}), 'string_agg', ''), '') as caption from pages) where caption <> ''
  union all select figure_id, 'rsc', 'Fig. 1 ' || caption from cap""")
def b13(spark, d):
    plain = pg.captions(given(spark, d, "pages").withColumnRenamed("html", "block")).select("page_id", F.lit("nature").alias("family"), "caption")
    return plain.union(rsc_captions(spark, d).select("page_id", F.lit("rsc"), "caption"))


@query("b14_image_url", f"""{HTML} select figure_id as page_id, 'nature' as family, concat('https://img.example.org/', cast(figure_id as varchar), '.jpg') as image_url from html
  union all select figure_id, 'nature', concat('https://img.example.org/', cast(figure_id as varchar), '_b.jpg') from cap, range(2) where figure_id % 4 = 1 union all select figure_id, 'rsc', concat('https://pubs.rsc.org/image/article/', cast(figure_id as varchar), '/large.gif') from cap""")
def b14(spark, d):
    plain = pg.captions(pg.figure_blocks(html(spark, d), "page_id")).select("page_id", F.lit("nature").alias("family"), pg.image_url(F.col("block")).alias("image_url"))
    return plain.union(rsc_captions(spark, d).select("page_id", F.lit("rsc"), pg.image_url(F.col("block"), "https://pubs.rsc.org", "rsc")))


@query("b12_nodes", r"""with c as (select page_id, regexp_replace(html, '(?s)(<(?:script|style)>).*?(</(?:script|style)>)|<!--.*?-->', '\1\2', 'g') as h from pages),
  t as (select page_id, unnest(regexp_extract_all(h, '<([a-z][a-z0-9]*)', 1)) as tag from c) select page_id, tag, count(*) as n from t group by all""")
def b12n(spark, d):
    return hp.node_table(given(spark, d, "pages"), "page_id").where("tag is not null").groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query("b12_within", f"{HTML} select figure_id as page_id, t.tag, cast(case t.tag when 'p' then case when figure_id % 4 = 1 then 5 else 2 end else case when figure_id % 4 = 1 then 3 else 1 end end as bigint) as n from html, (values ('p'), ('img')) t(tag)")
def b12w(spark, d):
    nodes = hp.node_table(html(spark, d), "page_id")
    pairs = hp.within(nodes.where("tag in ('p', 'img')"), nodes.where("tag = 'figure'"), "page_id")
    return pairs.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query("b15_number_figures", """select page_id, cast(row_number() over (partition by page_id order by p) as int) as figure_no, concat(cast(page_id as varchar), '_fig', cast(row_number() over (partition by page_id order by p) as varchar), '.jpg') as figure_name
  from (select page_id, unnest(range(len(regexp_extract_all(html, '(?s)<p[^>]*>(.*?)</p>', 1)))) as p from pages)""")
def b15(spark, d):
    paragraphs = given(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?s)<p[^>]*>(.*?)</p>"), F.lit(1))).alias("pos", "block"))
    return pg.number_figures(paragraphs, "page_id").select("page_id", "figure_no", "figure_name")


@query("b16_page_title", "select page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title from pages")
def b16(spark, d):
    return given(spark, d, "pages").select("page_id", pg.page_title(F.col("html")).alias("title"))


@query("b17_figure_record", f"{HTML} select cast(figure_id as varchar) as article_name, concat('Article ', cast(figure_id as varchar)) as title, figure_id % 2 = 0 as open, concat(cast(figure_id as varchar), '_fig', cast(k + 1 as varchar), '.jpg') as figure_name, [caption, 'InnerOuter & last', 'Inner'][k + 1] as full_caption, concat('https://img.example.org/', cast(figure_id as varchar), case when k = 0 then '.jpg' else '_b.jpg' end) as image_url, 'unknown' as license from cap, range(3) r(k) where k = 0 or figure_id % 4 = 1")
def b17(spark, d):
    return pg.figure_record(html(spark, d), "page_id").select("article_name", "title", "open", "figure_name", "full_caption", "image_url", "license")


@query("b18_merge_figures", "select o_orderkey, case when o_orderkey % 3 = 0 then 'new' else 'old' end as run from orders where o_orderkey % 3 = 0 or o_orderkey % 2 = 0")
def b18(spark, d):
    o = given(spark, d, "orders").select("o_orderkey")
    return pg.merge_figures(o.where("o_orderkey % 2 = 0").withColumn("run", F.lit("old")), o.where("o_orderkey % 3 = 0").withColumn("run", F.lit("new")), "o_orderkey")


@query("b19_safe_extract", """with p as (select page_id, case when page_id % 9 = 0 then null else html end as html from pages), n as (select page_id, html, len(regexp_extract_all(html, '(?s)<p[ >].*?</p>')) as n from p)
  select page_id, case when html is null then 'no page' when regexp_extract(html, '(?s)<title>(.*?)</title>', 1) = '' then 'no title' when n = 0 then 'no text' else concat('ok ', cast(n as varchar)) end as outcome from n""")
def b19(spark, d):
    p = given(spark, d, "pages").withColumn("html", F.when(F.col("page_id") % 9 != 0, F.col("html")))
    good, bad = pg.safe_extract(p, "page_id")
    return good.select("page_id", F.concat(F.lit("ok "), F.col("n").cast("string")).alias("outcome")).union(bad.select("page_id", F.col("reason").alias("outcome")))
