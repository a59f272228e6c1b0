"""The registered queries of the operators, each over its whole table with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from figloom.functions.session import small_batches
from figloom.llm import bpe, chat, decontaminate, jaccard, langid, licenses, lm, manifest, rules, substrings, toxicity, urlfilter, whitening
from figloom.llm.folds import fold

TOKENIZER = "byte_bpe_50k.tiktoken"


def table(spark, sf_dir: str, name: str):
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: host/path and what becomes of the URLs that it fits.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op1_url_filter(spark, sf_dir):
    listed = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), listed).select("page_id", "host", "path", "rule", "verdict")


_OP1_SQL = """
with u as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, regexp_extract(rest, '^[^/?#]*') as raw, regexp_replace(regexp_extract(rest, '^[^?#]*'), '^[^/?#]*', '') as path from u),
j as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from h),
r(host_end, path_start, rule, verdict) as (values ('org', '/', 'org/', 'allow'), ('example.org', '/es/', 'example.org/es/', 'block'),
  ('example.org', '/en/1', 'example.org/en/1', 'block'), ('com', '/fr/', 'com/fr/', 'allow'), ('com', '/de/', 'com/de/', 'block')),
f as (select page_id, host, path, rule, verdict, row_number() over (partition by page_id order by length(rule) desc nulls last) as n
  from j left join r on starts_with(path, path_start) and (host = host_end or ends_with(host, '.' || host_end)))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from f where n = 1
"""


def op2_ngram_jaccard(spark, sf_dir):
    return jaccard.link(table(spark, sf_dir, "documents"), words=3, percent=90)


_OP2_SQL = r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, list_aggregate(w[i:i + 2], 'string_agg', ' ') as g
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
k as (select g from s group by g having count(*) > 1),
i as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join k using (g) join s b using (g) where a.doc_id < b.doc_id group by all),
l as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 90 * (x.n + y.n - i)),
e as (select a, b from l union all select b, a from l),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
m as (select a, min(b) as b from r group by a),
c as (select min(w.doc_id) as class_id, sets.g from (select doc_id, list(g order by g) as g from s group by doc_id) sets join w using (doc_id) group by sets.g)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.class_id, w.doc_id) as class_id, least(w.doc_id, coalesce(m.b, w.doc_id)) as component_id
from w left join n using (doc_id) left join (select doc_id, list(g order by g) as g from s group by doc_id) x using (doc_id) left join c on c.g = x.g
left join m on m.a = w.doc_id
"""


def op3_substrings(spark, sf_dir):
    found = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


_OP3_SQL = r"""
with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, unnest(generate_series(1, len(w) - 34)) as i, w from w where len(w) >= 35),
g as (select doc_id, i, list_aggregate(w[i:i + 34], 'string_agg', ' ') as g from s),
r as (select doc_id, i from g where g in (select g from g group by g having count(*) > 1)),
c as (select doc_id, list_distinct(flatten(list(generate_series(i, i + 34)))) as c from r group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(c), 0) as bigint) as n_removed,
  sha256(coalesce(list_aggregate(list_filter(w, lambda x, k: c is null or not list_contains(c, k)), 'string_agg', ' '), '')) as kept_sha256
from w left join c using (doc_id)
"""


def op4_decontaminate(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = langid.fit(docs.where(fold(4) != 2))
    return langid.predict(docs, models).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op6_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.score(docs, model, ["doc_id"]).select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op8_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = lm.term_counts(docs)
    words = lm.vocabulary(docs, counts)
    return lm.score(docs, words, lm.train(docs, words), counts)


def op9_chat(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_chats(turns.unionByName(extra)))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256)
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


_OP9_SQL = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o as (select *, row_number() over w as i, lag(role) over w as before, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') as e,
  regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g') as er from t window w as (partition by conv_id order by turn, role, text))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(e) + case when before is distinct from role then length(er) + length('<|turn|><|says|><|end|>') else length('<|more|>') end) as bigint) as formatted_chars
from o group by conv_id
"""


def op10_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = rules.fit_and_judge(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*manifest.FIELDS)
    fields = [F.replace("text", F.lit("\n"), F.lit("")) if f == "text" else f for f in manifest.FIELDS]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = manifest.proofs(docs.withColumn("other", F.when(touched, F.unhex(manifest.leaf(fields)))), carry=("other",))
    folded = found.withColumn("folded_root", manifest.fold(F.coalesce(F.lower(F.hex("other")), "leaf"), F.col("segment")))
    return folded.select("doc_id", "leaf", "subroot", "root", manifest.proof(F.col("segment")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_OP11_SQL = """
with recursive b as (select *, {told} || {text} as told, {told} || {changed} as other,
    list_reduce([4294967295] || list_transform(range(1, length(cast(doc_id as varchar)) + 1), lambda k: ascii(cast(doc_id as varchar)[k])),
      lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))) as crc from documents),
p as (select doc_id, source, sha256(told) as leaf, sha256(case when crc & 1 = 1 then other else told end) as leaf2 from b),
l as (select *, dense_rank() over (order by source nulls first) - 1 as g, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
  count(*) over (partition by source) as n from p),
t as (select g, 0 as lvl, i, leaf as h, n from l
  union all select g, lvl + 1, i // 3, sha256(string_agg(h, '' order by i)), max((n + 2) // 3) from t where n > 1 group by g, lvl, i // 3),
r as (select g, h as subroot, count(*) over () as n from t where n = 1),
u as (select 0 as lvl, g as i, subroot as h, n from r
  union all select lvl + 1, i // 3, sha256(string_agg(h, '' order by i)), max((n + 2) // 3) from u where n > 1 group by lvl, i // 3),
s as (select l.g, l.i, t.lvl, coalesce(string_agg(t.h, '' order by t.i) filter (t.i < l.i // cast(pow(3, lvl) as bigint)), '') || '|' ||
    coalesce(string_agg(t.h, '' order by t.i) filter (t.i > l.i // cast(pow(3, lvl) as bigint)), '') as e
  from l join t on t.g = l.g and t.n > 1 and t.i // 3 = l.i // cast(pow(3, lvl + 1) as bigint) group by l.g, l.i, t.lvl
  union all select l.g, l.i, 100 + u.lvl, coalesce(string_agg(u.h, '' order by u.i) filter (u.i < l.g // cast(pow(3, lvl) as bigint)), '') || '|' ||
    coalesce(string_agg(u.h, '' order by u.i) filter (u.i > l.g // cast(pow(3, lvl) as bigint)), '')
  from l join u on u.n > 1 and u.i // 3 = l.g // cast(pow(3, lvl + 1) as bigint) group by l.g, l.i, u.lvl),
w as (select g, i, list(e order by lvl) as way from s group by g, i),
f as (select doc_id, leaf, subroot, (select h from u where n = 1) as root, sha256(replace(coalesce(array_to_string(way, ''), ''), '|', '')) as proof_sha256,
    list_reduce([leaf2] || coalesce(way, []), lambda a, e: sha256(split_part(e, '|', 1) || a || split_part(e, '|', 2))) as folded_root
  from l join r using (g) left join w using (g, i))
select *, folded_root = root as verified from f
""".format(
    told=" || ".join(f"coalesce(strlen(cast({f} as varchar)) || ':' || cast({f} as varchar), '-')" for f in manifest.FIELDS[:-1]),
    text="coalesce(strlen(text) || ':' || text, '-')",
    changed="coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')",
)


def op12_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_ngram_jaccard, op3_substrings, op4_decontaminate, op5_language, op6_byte_bpe, op7_toxicity, op8_lm, op9_chat, op10_quality_rules, op11_merkle_manifest, op12_license_scan, op13_whitening)}
ORACLES = {"op1_url_filter": _OP1_SQL, "op2_ngram_jaccard": _OP2_SQL, "op3_substrings": _OP3_SQL, "op9_chat": _OP9_SQL, "op11_merkle_manifest": _OP11_SQL}
