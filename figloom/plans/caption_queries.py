"""Queries of caption mining over derived captions."""

from pyspark.sql import functions as F

from figloom.operators import captions as cp
from figloom.plans.fixtures import ctes, derived, given
from figloom.plans.registry import query

G = "figure_id"
CAP = ctes("cap")
# Captions with more forms than the plain one, by the figure's number: ranges, lists, one-sided labels, colons, capitals.
_MORE = [("(b)", "case when figure_id % 3 = 0 then '(b, c)' when figure_id % 3 = 1 then '(b-d)' else '(b)' end"), ("(e)", "case when figure_id % 2 = 0 then '(e and f)' else '(C)' end"), ("(f)", "case when figure_id % 5 = 0 then 'as shown in (a)' else '(f)' end"),
  ("(g)", "case figure_id % 6 when 0 then 'g)' when 1 then 'g:' when 2 then ':g:' when 3 then '(g1)' when 4 then '(g ' else '. g, h' end"), ("(d)", "case figure_id % 7 when 0 then '(upper left)' when 1 then '(iv)' when 2 then ': d' when 3 then 'd and e)' else '(d)' end")]
_MIXED = "caption"
for _old, _new in _MORE:
    _MIXED = f"replace({_MIXED}, '{_old}', {_new})"
# Some captions are delimited by capitals, digits, numerals or words of position, or end in their labels.
for _when, _names in [("figure_id % 16 = 3", "ABCDEFG"), ("figure_id % 16 = 7", "1234567"), ("figure_id % 16 = 11", ["ii", "iii", "iv", "vi", "vii", "viii", "ix"]), ("figure_id % 16 = 15", ["upper left", "top", "Left and right", "in", "below", "out", "end"])]:
    _plain = "caption"
    for _letter, _name in zip("abcdefg", _names, strict=True):
        _plain = f"replace({_plain}, '({_letter})', '({_name})')"
    _MIXED = f"case when {_when} then {_plain} else {_MIXED} end"
_MIXED = f"case when figure_id % 8 = 5 then upper({_MIXED}) when figure_id % 32 = 1 then concat('TEM of ', cast(figure_id as varchar(20)), ' (a) and its map (b, c).') when figure_id % 32 = 2 then 'One (ii–iv) and shown in (v) more. (vi-ix) last' else {_MIXED} end"
MIX = f"{CAP}, mix as (select figure_id, {_MIXED} as caption from cap)"


def _run(c: str, more: str = "") -> str:
    """The twin's pattern of runs of a label."""
    r = rf"{c}(?:(?:\s*(?:,|–|-|(?i:and)|,\s*(?i:and))\s*){c})*"
    return rf"(?:\({r}\)|{more}:{r}:|\({r}|:{r}|{r}[):])"


_TENS = [t + u for t in ("", "x", "xx", "xxx", "xl") for u in ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")][1:] + ["l"]
_ROMAN = "[" + ", ".join(f"'{x}'" for x in _TENS) + "]"
_PATTERNS = {"alpha": _run(r"\b[a-z]\b", r"\([a-z][0-9]\)|\. [a-z]\b(?:(?:,|–) ?[a-z]\b)?|"), "ALPHA": _run(r"\b[A-Z]\b", r"\([A-Z][0-9]\)|"), "digit": _run(r"\b[0-9]\b"), "roman": _run(rf"\b(?i:{'|'.join(_TENS)})\b"),
  "position": _run(r"\b(?i:above|after|around|before|beginning|behind|below|beside|between|bottom|center|down|end|far|finish|front|in|inside|lower|left|middle|near|next to|off|on|out|outside|over|right|start|through|top|under|up|upper|upside down)\b")}
SPANS = f"""{MIX},
e as materialized ({" union all ".join(f"select figure_id, '{k}' as kind, regexp_extract_all(caption, '{p}') as s, regexp_split_to_array(caption, '{p}') as p from mix" for k, p in _PATTERNS.items())}),
spans as materialized (select figure_id, kind, s[i] as span, cast(coalesce(length(list_aggregate(p[1:i], 'string_agg', '')), 0) + coalesce(length(list_aggregate(s[1:i - 1], 'string_agg', '')), 0) + 1 as int) as pos from (select *, unnest(range(1, len(s) + 1)) as i from e)),
dn as (select figure_id, count(*) filter (kind = 'alpha') as alpha, count(*) filter (kind = 'ALPHA') as upper, count(*) filter (kind = 'digit') as digit, count(*) filter (kind = 'roman') as roman,
  count(*) filter (kind = 'position') as position, min_by(kind, (pos, kind)) as first from spans group by figure_id),
delims as materialized (select figure_id, case when greatest(alpha, upper) >= 0.25 * greatest(alpha, upper, digit, roman, position) then case when 0.5 * upper > alpha then 'ALPHA' else 'alpha' end
  when roman = greatest(alpha, upper, digit, roman, position) then 'roman' else first end as delimiter from dn)"""


def mixed(spark, d):
    return derived(spark, d, "cap").select(G, F.expr(_MIXED).alias("caption"))


def spans(spark, d):
    return cp.label_spans(mixed(spark, d), G)


@query("c1_label_spans", f"{SPANS} select figure_id, kind, span, pos from spans")
def c1(spark, d):
    return spans(spark, d)


@query("c2_delimiter", f"{SPANS} select figure_id, delimiter from delims")
def c2(spark, d):
    told = mixed(spark, d).select(G, cp.delimiter_of(cp.span_array(F.col("caption"))).alias("delimiter"))
    return told.where("delimiter is not null")


@query("c2_delimiter_of_spans", f"{SPANS} select figure_id, delimiter from delims")
def c2s(spark, d):
    return cp.delimiter(spans(spark, d), G)


@query("c3_longest_spans", f"""{SPANS}, w as (select *, max(pos + length(span)) over (partition by figure_id order by pos, length(span) desc rows between unbounded preceding and 1 preceding) as b from spans),
  r as (select *, sum(case when b is null or pos >= b then 1 else 0 end) over (partition by figure_id order by pos, length(span) desc rows unbounded preceding) as run from w)
  select figure_id, min_by(pos, (-length(span), pos, kind)) as pos, min_by(span, (-length(span), pos, kind)) as span from r group by figure_id, run""")
def c3(spark, d):
    return cp.longest_spans(spans(spark, d), G).select(G, "pos", "span")


@query("c4_drop_chemistry", f"""{SPANS} select figure_id, kind, span, pos from spans join delims using (figure_id)
  where not regexp_full_match(span, '\\([a-z]') and not (regexp_full_match(span, '\\((B|C|F|H|I|K|N|O|P|S|U|V|W|Y)\\)') and delimiter <> 'ALPHA') and not regexp_full_match(span, '\\((In|IN|No|NO|At|AT)\\)')""")
def c4(spark, d):
    s = spans(spark, d)
    return cp.drop_chemistry(s.join(cp.delimiter(s, G), G)).select(G, "kind", "span", "pos")


@query("c5_drop_molecules", f"{SPANS} select figure_id, kind, span, pos from spans where not contains(span, 'b, c') and not contains(span, 'e and')")
def c5(spark, d):
    return cp.drop_molecules(spans(spark, d), spark.createDataFrame([("b, c",), ("e and",)], "name string"))


@query("c5_molecule_table", f"""{SPANS}, m as (select distinct concat(substr('abcdefg', cast(1 + p_partkey % 7 as int), 1), ', ', substr('abcdefg', cast(1 + p_size % 7 as int), 1)) as name from part)
  select figure_id, kind, span, pos from spans where not exists (select 1 from m where contains(span, name))""")
def c5t(spark, d):
    letter = lambda n: F.substring(F.lit("abcdefg"), (n % 7 + 1).cast("int"), F.lit(1))
    return cp.drop_molecules(spans(spark, d), given(spark, d, "part").select(F.concat(letter(F.col("p_partkey")), F.lit(", "), letter(F.col("p_size"))).alias("name")).distinct())


_IMPLIED = rf"""case when kind = 'position' then list_sort(list_distinct(list_filter(list_transform(string_split_regex(regexp_replace(span, '[().:]', '', 'g'), '(?i),|–|-|\band\b'), lambda x: trim(x)), lambda x: lower(x) in ('upper', 'left', 'in', 'out', 'end', 'right', 'top', 'below')))) else
  list_sort(list_distinct(flatten(list_transform(list_filter(string_split_regex(regexp_replace(regexp_replace(span, '[().:\s]', '', 'g'), '(?i)and', ',', 'g'), ',+'), lambda x: x <> ''),
  lambda x: case when kind = 'roman' and regexp_full_match(x, '[a-zA-Z]+[–-][a-zA-Z]+') and list_position({_ROMAN}, lower(string_split_regex(x, '[–-]')[1])) <= list_position({_ROMAN}, lower(string_split_regex(x, '[–-]')[2]))
      then list_transform({_ROMAN}[list_position({_ROMAN}, lower(string_split_regex(x, '[–-]')[1])):list_position({_ROMAN}, lower(string_split_regex(x, '[–-]')[2]))], lambda n: case when x[1:1] = lower(x[1:1]) then n else upper(n) end)
    when regexp_full_match(x, '[a-zA-Z0-9][–-][a-zA-Z0-9]') and ascii(x[1:1]) <= ascii(x[-1:]) then list_transform(range(ascii(x[1:1]), ascii(x[-1:]) + 1), lambda c: chr(cast(c as int))) else string_split_regex(x, '[–-]') end)))) end"""


@query("c6_implied_labels", f"{SPANS} select figure_id, kind, pos, list_aggregate({_IMPLIED}, 'string_agg', ',') as labels from spans")
def c6(spark, d):
    return spans(spark, d).select(G, "kind", "pos", F.array_join(cp.implied_labels(F.col("span"), F.col("kind")), ",").alias("labels"))


@query("c7_char_range", f"{CAP} select figure_id, array_to_string(list_transform(range(figure_id % 5, figure_id % 5 + figure_id % 7 + 1), lambda i: chr(cast(97 + i as int))), ',') as letters, array_to_string(['i','ii','iii','iv','v','vi','vii','viii','ix','x','xi','xii','xiii','xiv','xv'][figure_id % 5 + 1:figure_id % 5 + figure_id % 7 + 1], ',') as romans from cap")
def c7(spark, d):
    a, n = F.col(G) % 5, F.col(G) % 7
    table = F.array(*map(F.lit, cp.ROMAN))
    ends = [F.get(table, x.cast("int")) for x in (a, a + n)]
    return derived(spark, d, "cap").select(G, F.array_join(cp.char_range(F.char(97 + a), F.char(97 + a + n)), ",").alias("letters"), F.array_join(F.array_distinct(F.when(n == 0, F.array(ends[0])).otherwise(cp.char_range(*ends, roman_first=True))), ",").alias("romans"))


@query("c8_position_labels", """select p_partkey, word from (select p_partkey, unnest(string_split(replace(replace(p_name, 'hot', 'Top'), 'rod', 'Behind'), ' ')) as word from part) where lower(word) in ('above', 'after', 'around', 'before', 'beginning', 'behind', 'below', 'beside',
  'between', 'bottom', 'center', 'down', 'end', 'far', 'finish', 'front', 'in', 'inside', 'lower', 'left', 'middle', 'near', 'next to', 'off', 'on', 'out', 'outside', 'over', 'right', 'start', 'through', 'top', 'under', 'up', 'upper', 'upside down')""")
def c8(spark, d):
    words = given(spark, d, "part").select("p_partkey", F.explode(F.split(F.replace(F.replace("p_name", F.lit("hot"), F.lit("Top")), F.lit("rod"), F.lit("Behind")), " ")).alias("word"))
    return cp.position_labels(words, "word")


_LABELS = f"{SPANS}, i as (select figure_id, unnest({_IMPLIED}) as l from spans where kind = 'alpha')"


@query("c9_suggested_labels", f"{_LABELS} select figure_id, string_agg(distinct l, ',' order by l) as labels from i group by figure_id")
def c9(spark, d):
    return cp.suggested_labels(spans(spark, d).where("kind = 'alpha'"), G).select(G, F.array_join("labels", ",").alias("labels"))


_LIKELY = """coalesce(list_max(list_transform(o, lambda x: ascii(lower(x)))) > ascii('{l}'), false) or len(list_filter(o, lambda x: abs(ascii(lower(x)) - ascii('{l}')) = 1)) > 0
  or (len(list_filter(g, lambda y: list_contains(y, '{l}') and list_has_any(y, o))) > 0 and len(list_filter(g, lambda y: list_contains(y, '{l}') and len(list_filter(y, lambda x: regexp_full_match(x, '[0-9]+'))) > 0)) = 0)"""


@query("c10_likely_label", f"""{_LABELS}, s as (select figure_id, list_distinct(list(l)) as s from i group by figure_id), t as (select figure_id, s, list_transform(regexp_extract_all(caption, '\\([^)]*\\)'), lambda y: list_filter(string_split(regexp_replace(y, '[^\\w\\s]', ' ', 'g'), ' '), lambda x: x not in ('and', ''))) as g from s join mix using (figure_id)),
  {", ".join(f"o_{x} as (select figure_id, {_LIKELY.format(l=x)} as likely_{x} from (select figure_id, g, list_filter(s, lambda x: lower(x) <> '{x}' and regexp_full_match(lower(x), '[a-z]')) as o from t))" for x in ("b", "g", "h", "q"))}
  select figure_id, likely_b, likely_g, likely_h, likely_q from o_b join o_g using (figure_id) join o_h using (figure_id) join o_q using (figure_id)""")
def c10(spark, d):
    s = cp.suggested_labels(spans(spark, d).where("kind = 'alpha'"), G).join(mixed(spark, d), G)
    return s.select(G, *(cp.likely_label(F.lit(x), F.col("labels"), F.col("caption")).alias(f"likely_{x}") for x in ("b", "g", "h", "q")))


@query("c11_require_a", f"{_LABELS} select figure_id, case when bool_or(l in ('a', 'A')) or not bool_or(regexp_full_match(l, '[A-Za-z]')) then string_agg(distinct l, ',' order by l) else '0' end as labels from i group by figure_id")
def c11(spark, d):
    return cp.suggested_labels(spans(spark, d).where("kind = 'alpha'"), G).select(G, F.array_join(cp.require_a(F.col("labels")), ",").alias("labels"))


@query("c12_subfigure_count", f"{_LABELS} select figure_id, count(distinct l) as n from i group by figure_id")
def c12(spark, d):
    return cp.subfigure_count(spans(spark, d).where("kind = 'alpha'"), G)


@query("c13_subfigure_labels", f"{SPANS} select figure_id, string_agg(span, ' ' order by pos) as labels from spans where kind = 'alpha' group by figure_id")
def c13(spark, d):
    return cp.subfigure_labels(spans(spark, d).where("kind = 'alpha'"), G).select(G, F.array_join("labels", " ").alias("labels"))


# Each caption begins with one of the sequences that are written otherwise, by the figure's number, and some lack the full stop.
_ODD = ["(a)-(b) ", "(a)–(b) ", "of:(a) ", "(a): ", "Both. From left to right: (a) ", "A pair of image (c) ", "(a) : ", "1 – ", "2 – ", "3 – ", "N-C. ", "one.  (a) ", "a part ", "A part ", "one; images of b; c .; d "]
_ODD_SQL = f"concat([{', '.join(repr(x) for x in _ODD)}][figure_id % {len(_ODD)} + 1], case when figure_id % 2 = 0 then caption else replace(caption, '.', '') end)"
_PLAIN = "caption"
for _a, _b in [(")-(", "-"), (")–(", "–"), (":(", ": ("), ("):", ") :")]:
    _PLAIN = f"replace({_PLAIN}, '{_a}', '{_b}')"
_PLAIN = f"regexp_replace({_PLAIN}, ' +', ' ', 'g')"
_PLAIN = f"case when len(string_split({_PLAIN}, '; ')) > len(string_split({_PLAIN}, '. ')) then replace(replace(replace({_PLAIN}, 'one; images', 'one; images'), 'images of b; ', 'images of b, '), 'c .; ', 'c ., ') else {_PLAIN} end"
for _a, _b in [(". From left to right: (a)", ": (a)"), ("of image (", "shown in image ("), ("(a) :", ": (a)"), ("1 –", "1 -"), ("2 –", "2 -"), ("3 –", "3 -"), ("N-C.", "N-C ."), (". ", " . "), (". (a)", " (a)")]:
    _PLAIN = f"replace({_PLAIN}, '{_a}', '{_b}')"


@query("c14_normalize_caption", f"""{CAP}, odd as (select figure_id, {_ODD_SQL} as caption from cap), n as (select figure_id, {_PLAIN} as c from odd),
  m as (select figure_id, case when left(c, 2) in ('a ', 'A ') then concat('(', left(c, 1), ')', substr(c, 2)) else c end as c from n)
  select figure_id, case when right(c, 1) = '.' then c else c || ' .' end as caption from m""")
def c14(spark, d):
    prefix = F.get(F.array(*map(F.lit, _ODD)), (F.col(G) % len(_ODD)).cast("int"))
    odd = F.concat(prefix, F.when(F.col(G) % 2 == 0, F.col("caption")).otherwise(F.replace("caption", F.lit("."), F.lit(""))))
    return derived(spark, d, "cap").select(G, cp.normalize_caption(odd).alias("caption"))


_SEG = rf"""{SPANS}, g as (select figure_id, delimiter, regexp_replace(caption, '(?i)\b(denoted|corresponds|extracted|indicated|shown|corresponding)( in| by| to| from)? \(([^()]*)\)', '\1\2 ⟨\3⟩', 'g') as c from mix join delims using (figure_id)),
z as materialized ({" union all ".join(f"select figure_id, delimiter, regexp_split_to_array(c, '{p}') as p, regexp_extract_all(c, '{p}') as s from g where delimiter = '{k}'" for k, p in _PATTERNS.items())}),
seg as materialized (select figure_id, cast(i as int) as seq, delimiter as kind, s[i + 1] as span, translate(trim(case when trim(p[1]) <> '' and trim(translate(p[-1], '.', ' ')) = '' then p[i + 1] else p[i + 2] end), '⟨⟩', '()') as segment from (select *, unnest(range(0, len(s))) as i from z))"""


def segs(spark, d):
    return cp.segments(mixed(spark, d), G)


@query("c15_segments", f"{_SEG} select figure_id, seq, kind, span, segment from seg")
def c15(spark, d):
    return segs(spark, d)


# With both marks, without the trigger, without the stop, with equal parts, with more full stops; the figure's number makes each row its own.
_SEMI = ["TEM images of #; gold; silver .; end of #", "map of #; gold; silver .; gold", "first; images of #; gold; iron", "gold; images of #; gold; iron .; gold; end", "images of #. One. Two. Three; four", "# images of gold ."]
_SEMI_SQL = f"replace([{', '.join(repr(x) for x in _SEMI)}][figure_id % {len(_SEMI)} + 1], '#', cast(figure_id as varchar))"


@query("c16_repair_semicolons", f"""{CAP}, r as (select figure_id, {_SEMI_SQL} as t from cap), p as (select figure_id, t, string_split(t, '; ') as p from r),
  f as (select *, list_position(list_transform(p, lambda x: contains(x, 'images of')), true) as a from p),
  l as (select *, coalesce(list_max(list_filter(range(1, len(p) + 1), lambda i: i >= a and contains(p[i], ' .'))), len(p)) as z from f),
  w as (select *, case when a > 0 then p[a:z] else p[-1:] end as w from l)
  select figure_id, case when len(p) > len(string_split(t, '. ')) then array_to_string(list_transform(p, lambda x, i: x || case when i = len(p) then '' when list_contains(w, x) then ', ' else '; ' end), '') else t end as caption from w""")
def c16(spark, d):
    raw = F.replace(F.get(F.array(*map(F.lit, _SEMI)), (F.col(G) % len(_SEMI)).cast("int")), F.lit("#"), F.col(G).cast("string"))
    return derived(spark, d, "cap").select(G, cp.repair_semicolons(raw, "images of", " .").alias("caption"))


@query("c17_prune_similar")
def c17(spark, d):
    return cp.prune_similar(segs(spark, d), G, "seq", "segment", 0.7).select(G, "seq")


@query("c17_prune_similar_native", f"""{_SEG}, n as (select a.figure_id, case when length(a.segment) < length(b.segment) then a.seq else b.seq end as seq from seg a join seg b on a.figure_id = b.figure_id and a.seq < b.seq
  where 1 - levenshtein(a.segment, b.segment) / cast(greatest(length(a.segment), length(b.segment), 1) as double) >= 0.7)
  select figure_id, seq from seg where (figure_id, seq) not in (select (figure_id, seq) from n)""")
def c17n(spark, d):
    return cp.prune_similar_native(segs(spark, d), G, "seq", "segment", 0.7).select(G, "seq")


@query("c18_clean_segment", rf"{_SEG} select figure_id, seq, regexp_replace(segment, '^[\s.,;:]+|[\s.,;:]+$', '', 'g') as segment from seg")
def c18(spark, d):
    form = F.get(F.array(*map(F.lit, ["(a)", "a)", ":b:", ". c", "(d, e)", "e, f:"])), (F.col("seq") + F.col(G) % 6).cast("int") % 6)
    return segs(spark, d).select(G, "seq", cp.clean_segment(F.concat(form, F.lit(" "), "segment")).alias("segment"))


@query("c19_drop_shared_text", f"""{_SEG} select figure_id, seq, segment from seg a where not exists (select 1 from seg b where b.figure_id = a.figure_id and b.seq <> a.seq and b.segment <> '' and contains(a.segment, b.segment))""")
def c19(spark, d):
    return cp.drop_shared_text(segs(spark, d), G).select(G, "seq", "segment")


TERMS = {"part": ["PROMO", "rod", "bolt"], "economy": ["ECONOMY"], "place": ["from", "", "with"]}
_TAGS = " union all ".join(f"select {{key}}, '{t}' as term from {{table}} where {' or '.join(f'''contains({{text}}, '{s}')''' for s in syn if s)}" for t, syn in TERMS.items())


@query("c20_tag_keywords", _TAGS.format(key="doc_id", table="documents", text="text"))
def c20(spark, d):
    return cp.tag(given(spark, d, "documents"), "doc_id", "text", TERMS)


@query("c21_tag_general", f"{CAP} {_TAGS.format(key='figure_id', table='cap', text='caption')}")
def c21(spark, d):
    return cp.tag(derived(spark, d, "cap"), G, "caption", TERMS)


# A taxonomy of the parts' names: the first two words are a synonym of the type's last.
_TAXONOMY = "x as (select distinct string_split(p_type, ' ')[-1] as term, concat(string_split(p_name, ' ')[1], ' ', string_split(p_name, ' ')[2]) as synonym from part)"


@query("c21_taxonomy", f"{CAP}, {_TAXONOMY} select distinct figure_id, term from cap join x on contains(caption, synonym)")
def c21t(spark, d):
    words = F.split("p_name", " ")
    terms = given(spark, d, "part").select(F.element_at(F.split("p_type", " "), -1).alias("term"), F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))).alias("synonym")).distinct()
    return cp.tag(derived(spark, d, "cap"), G, "caption", terms)


@query("c20_terms_of_items", """with x as (select item_id as term, unnest(string_split(text, ' ')) as w from benchmark), y as (select distinct cast(term as varchar) as term, w as synonym from x where length(w) > 6)
  select distinct doc_id, term from documents join y on contains(text, synonym)""")
def c20t(spark, d):
    words = given(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("term"), F.explode(F.split("text", " ")).alias("synonym"))
    return cp.tag(given(spark, d, "documents"), "doc_id", "text", words.where(F.length("synonym") > 6).distinct())


@query("c22_fan_out", f"{_SEG} select distinct figure_id, unnest({_IMPLIED}) as label, segment from seg")
def c22(spark, d):
    return cp.fan_out(segs(spark, d), G)


@query("c23_unique_remainder", f"""{_SEG}, h as (select a.figure_id, a.seq, a.segment, min_by(b.segment, (-length(b.segment), b.segment)) filter (b.segment <> '' and contains(a.segment, b.segment)) as t from seg a left join seg b on b.figure_id = a.figure_id and b.seq < a.seq group by all)
  select figure_id, seq, case when t is null then segment else trim(replace(segment, t, '')) end as remainder from h""")
def c23(spark, d):
    return cp.unique_remainder(segs(spark, d), G).select(G, "seq", "remainder")


@query("c24_propagate_keywords", f"{_SEG}, f as (select figure_id, unnest({_IMPLIED}) as label, string_split(segment, ' ')[1] as w from seg) select figure_id, label, string_agg(distinct w, ',' order by w) as keywords from f group by all")
def c24(spark, d):
    rows = segs(spark, d).select(G, F.explode(cp.implied_labels(F.col("span"), F.col("kind"))).alias("label"), F.array(F.get(F.split("segment", " "), F.lit(0))).alias("keywords"))
    return cp.propagate_keywords(rows, G).select(G, "label", F.array_join("keywords", ",").alias("keywords"))


@query("c25_distribute", f"{_SEG} select mix.figure_id, count(span) as n, coalesce(string_agg(span || segment, '|' order by seq), '') as entries from mix left join seg using (figure_id) group by mix.figure_id")
def c25(spark, d):
    m = mixed(spark, d)
    out = cp.distribute(m.select(G), segs(spark, d), cp.delimiter(spans(spark, d), G), G)
    return out.select(G, F.size("entries").cast("long").alias("n"), F.array_join(F.transform("entries", lambda e: F.concat(e["span"], e["segment"])), "|").alias("entries"))
