"""Tables that Spark and DuckDB derive alike from the given ones: boxes, label texts, captions, pages, subfigures."""

_BOX = """select l_orderkey as figure_id, l_linenumber as idx, l_linenumber % 3 as kind,
  cast(min(l_partkey) % 300 as int) as x1, cast(min(l_suppkey) * 3 % 300 as int) as y1,
  cast(floor(min(l_partkey) % 300 + 10 + min(l_quantity) * (case when l_linenumber % 3 = 0 then 6 else 1 end)) as int) as x2,
  cast(floor(min(l_suppkey) * 3 % 300 + 6 + max(l_quantity) * (case when l_linenumber % 3 = 0 then 6.0e0 else 0.5e0 end)) as int) as y2,
  round(0.3e0 + min(l_discount) * 6, 4) as confidence
from {lineitem} group by l_orderkey, l_linenumber"""
_LBL = """select l_orderkey as figure_id, l_linenumber as idx,
  concat(cast(cast(min(l_quantity) as int) as varchar(10)), ' ', case l_linenumber % 6 when 0 then 'A' when 1 then 'nm' when 2 then 'um' when 3 then 'mm' when 4 then 'n' else 'px' end) as text,
  round(min(l_tax) * 10, 4) as label_confidence
from {lineitem} group by l_orderkey, l_linenumber"""
_CAP = """select figure_id, concat('Overview of figure ', cast(figure_id as varchar(20)), '. ', @JOINED@) as caption
from (select l_orderkey as figure_id, l_linenumber as pos, min(l_partkey) as pk from {lineitem} group by l_orderkey, l_linenumber) i
join {part} on p_partkey = pk group by figure_id"""
_PIECE = "concat('(', substr('abcdefg', pos, 1), ') ', p_type, ' image of ', p_name, ' at ', cast(p_size as varchar(10)), ' nm.')"
_ENT = f"""select figure_id, pos, concat('(', substr('abcdefg', pos, 1), ').') as label, {_PIECE} as description, p_type as keyword
from (select l_orderkey as figure_id, l_linenumber as pos, min(l_partkey) as pk from {{lineitem}} group by l_orderkey, l_linenumber) i join {{part}} on p_partkey = pk"""
_SUB = """select figure_id, idx, case when figure_id % 5 = 0 then 'z' when figure_id % 2 = 1 then upper(substr('abcdefg', idx, 1)) else substr('abcdefg', idx, 1) end as label,
  case figure_id % 8 when 0 then 'microscopy' when 1 then 'diffraction' when 2 then 'graph' when 3 then 'basic_photo' when 4 then 'illustration' when 5 then 'unclear' when 6 then 'parent' else 'background' end as classification,
  x1, y1, x2, y2, confidence, o_custkey as article_id, c_name as title, c_nationkey % 2 = 0 as open
from {box} b join {orders} on o_orderkey = figure_id join {customer} on c_custkey = o_custkey where kind = 0"""
_HTML = """select figure_id, concat('<html><head><title>Article ', cast(figure_id as varchar(20)), '</title><script data-test="dataLayer">dataLayer=[{{"content":{{"attributes":{{"copyright":{{"open":',
  case when figure_id % 2 = 0 then 'true' else 'false' end, '}}}}}},"page":{{"search":{{"page":1,"totalPages":', cast(figure_id % 4 + 1 as varchar(20)),
  ',"totalResults":12}}}}}}];</script></head><body><ul><li><div><h3><a href="/articles/', cast(figure_id as varchar(20)), '?page=search">one<br></a></h3><span class="text-orange">', case when figure_id % 3 = 0 then 'Closed' else 'Open' end,
  '</span></div></li><li><div><h3><a href="/articles/full/', cast(figure_id as varchar(20)), '">two</a></h3></div><p></p><img src="x"><span class="c text-orange">Open</span></li><li><div><h3><a href="/articles/', cast(figure_id as varchar(20)),
  '.pdf">three</a></h3></div></li></ul><span class="text-orange">Open</span><figure><img src="//img.example.org/', cast(figure_id as varchar(20)), '_hi-res.jpg"><p>', caption, '</p></figure>',
  case when figure_id % 4 = 1 then concat('<figure class="wide"><div><figure><img src="//img.example.org/', cast(figure_id as varchar(20)), '_b.jpg"><p>Inner</p></figure></div><p>Outer &amp; last</p></figure>') else '' end, '<figure><p></p></figure></body></html>') as html
from {cap}"""
_FAM = """select figure_id, concat('<html><body><h1>Results</h1><span class="result__count">', cast(figure_id % 300 as varchar(20)), '</span>', case figure_id % 3 when 0 then '<div class="article_header-open-access"><b>ACS AuthorChoice</b> ' when 1 then '<div class="article_header-open-access">ACS Editors'' Choice '
  else '<div class="article_header-open-access">Subscribed ' end, cast(figure_id as varchar(20)), '</div></body></html>') as acs,
  concat('<html><body><p>12 tabs</p>Back to tab navigation ', case when figure_id % 4 = 0 then '7 of ' else '' end, cast(figure_id % 500 as varchar(20)), ' results - Showing page 1 of 3<div class="image_table"><a href="/image/article/', cast(figure_id as varchar(20)), '/small.gif">s</a><a href="/image/article/',
  cast(figure_id as varchar(20)), '/large_hi-res.gif"><b>l</b></a><a href="/other">o</a><div class="inner"><div>pad</div></div><span class="graphic_title"><b>Fig. 1</b> ', caption, '</span></div><div class="image_table"><a href="/x/image/article/y">x</a></div></body></html>') as rsc
from {cap}"""
_SPARK_JOINED = f"array_join(transform(array_sort(collect_list(named_struct('p', pos, 't', {_PIECE}))), z -> z.t), ' ')"
_TEMPLATES = {"box": _BOX, "lbl": _LBL, "cap": _CAP, "ent": _ENT, "sub": _SUB, "html": _HTML, "fam": _FAM}
_NEEDS = {"box": [], "lbl": [], "cap": [], "ent": [], "sub": ["box"], "html": ["cap"], "fam": ["cap"]}
GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def given(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spark_sql(name: str, sf_dir: str) -> str:
    names = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in GIVEN} | {n: f"({_spark_sql(n, sf_dir)})" for n in _NEEDS[name]}
    return _TEMPLATES[name].replace("@JOINED@", _SPARK_JOINED).format(**names)


def derived(spark, sf_dir: str, name: str):
    return spark.sql(_spark_sql(name, sf_dir))


def ctes(*names: str) -> str:
    """`with` clause of the derived tables for DuckDB, with what they need."""
    order = [n for n in _TEMPLATES if n in names or any(n in _NEEDS[x] for x in names)]
    joined = f"string_agg({_PIECE}, ' ' order by pos)"
    plain = {t: t for t in [*GIVEN, *_TEMPLATES]}
    return "with " + ",\n".join(f"{n} as ({_TEMPLATES[n].replace('@JOINED@', joined).format(**plain)})" for n in order)
