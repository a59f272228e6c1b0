"""Caption mining: which labels a caption names, which text belongs to each, and which terms that text holds.

Without an English tagger the text is cut by rule: what stands before the first label is shared; a segment runs from its
label to the next; where a caption begins with text and ends in a label, the text before each label is its segment; and a
label behind a word of reference ("shown in (b)") opens no segment. Each caption is cut at the kind of label that delimits
it. Captions are rows, so everything is a projection
with array functions, or a grouping by caption."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from figloom.operators.labels import KINDS, POSITIONS, ROMAN
from figloom.operators.labels import spans as span_array
from figloom.operators.patterns import holds_none, with_held
from figloom.operators.similar import matched_rows

# Symbols of the chemical elements, which look like labels.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe "
    "Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr "
    "Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()
_JOINERS = r"(?:\s*(?:,|–|-|and|,\s*and)\s*)"


def label_spans(caps: DataFrame, key: str, text: str = "caption") -> DataFrame:
    """key, kind, span, pos (character it begins at) of every run of labels, of all kinds in one pass (C1): labels of a kind,
    (a, b) or (a-c) or (a and b), set off by brackets or colons on both sides or on one: (a), (a, a), :a:, :a, a:; a letter
    and a digit in brackets; small letters behind a full stop."""
    return caps.select(key, F.inline(span_array(F.col(text)))).select(key, "kind", "span", "pos")


def delimiter_of(found: Column) -> Column:
    """The kind of label that delimits a caption, from the array of its spans (C2, as delimiter does); null without any."""
    n = {k: F.size(F.filter(found, _of_kind(k))) for k in KINDS}
    first = F.array_min(F.transform(found, lambda s: F.struct(s["pos"], s["kind"])))["kind"]
    return _delimiter(n["alpha"], n["ALPHA"], n["digit"], n["roman"], n["position"], first)


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def _delimiter(alpha: Column, upper: Column, digit: Column, roman: Column, position: Column, first: Column) -> Column:
    most = F.greatest(alpha, upper, digit, roman, position)
    letters = F.when(0.5 * upper > alpha, "ALPHA").otherwise("alpha")
    return F.when(most == 0, None).when(F.greatest(alpha, upper) >= 0.25 * most, letters).when(roman == most, "roman").otherwise(first)


def delimiter(spans: DataFrame, key: str) -> DataFrame:
    """The kind of label that delimits each caption: letters if they are a quarter of the most frequent kind, capitals
    only if they are over twice the small ones; else roman if most frequent; else the first that occurs (C2)."""
    counts = spans.groupBy(key).agg(*(F.count_if(F.col("kind") == k).alias(k.replace("ALPHA", "upper")) for k in KINDS), F.min_by("kind", F.struct("pos", "kind")).alias("first"))
    return counts.select(key, _delimiter(*(F.col(c) for c in ("alpha", "upper", "digit", "roman", "position", "first"))).alias("delimiter"))


def longest_spans(spans: DataFrame, key: str) -> DataFrame:
    """Of each run of overlapping spans the longest, the first of equals."""
    end = F.col("pos") + F.length("span")
    w = Window.partitionBy(key).orderBy("pos", F.desc(F.length("span")))
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("_new", F.when(F.coalesce(F.col("pos") >= before, F.lit(True)), 1).otherwise(0)).withColumn("_run", F.sum("_new").over(w))
    best = runs.groupBy(key, "_run").agg(F.min(F.struct((-F.length("span")).alias("l"), "pos", "kind", "span")).alias("b"))
    return best.select(key, "b.kind", "b.pos", "b.span")


def drop_chemistry(spans: DataFrame, delimiter: str = "delimiter", elements: list[str] = ELEMENTS) -> DataFrame:
    """Without spans that name a chemical element alone, or a letter with its bracket left open; where capitals delimit the
    caption (told by the column delimiter), elements of one letter are labels (C4)."""
    inside = F.regexp_extract("span", r"^\(([A-Za-z]+)\)$", 1)
    told = F.upper(inside).isin(*(e.upper() for e in elements)) & (F.initcap(inside).isin(*elements)) & ((inside == F.initcap(inside)) | (inside == F.upper(inside)))
    named = told & ((F.col(delimiter) != "ALPHA") | (F.length(inside) > 1))
    return spans.where(~named & ~F.col("span").rlike(r"^\([a-z]$"))


def drop_molecules(spans: DataFrame, molecules: DataFrame) -> DataFrame:
    """Without spans that hold a known molecule (name); all names are looked for in one pass."""
    return holds_none(spans, "span", molecules.select(F.col("name").alias("pattern")))


def char_range(a: Column, b: Column, roman_first: bool = False) -> Column:
    """Letters, digits or roman numerals from a to b, both included; roman_first says how to read i, v and x."""
    table = F.array(*map(F.lit, ROMAN))
    i, j = F.array_position(table, a).cast("int"), F.array_position(table, b).cast("int")
    roman = F.slice(table, i, j - i + 1)
    code = F.transform(F.sequence(F.ascii(a), F.ascii(b)), lambda c: F.char(c.cast("long")))
    plain, numeral = (F.length(a) == 1) & (F.length(b) == 1) & (F.ascii(a) <= F.ascii(b)), (i > 0) & (j >= i)
    if roman_first:
        return F.when(numeral, roman).when(plain, code).otherwise(F.array(a, b))
    return F.when(plain, code).when(numeral, roman).otherwise(F.array(a, b))


def implied_labels(span: Column, kind: Column | None = None) -> Column:
    """Labels that a span stands for, each once, sorted: (a-c, e and f) is a, b, c, e, f (C6). kind tells how to read the
    ends of a range: (i-v) is nine letters or, of kind roman, five numerals; words of position are no ranges."""
    pieces = F.filter(F.split(F.regexp_replace(F.regexp_replace(span, r"[().:\s]", ""), r"(?i)and", ","), ",+"), lambda x: x != "")
    words = F.filter(F.transform(F.split(F.regexp_replace(span, r"[().:]", ""), r"(?i),|–|-|\band\b"), lambda x: F.trim(x)), lambda x: F.lower(x).isin(*POSITIONS))

    def one(x: Column) -> Column:
        a, b = F.get(F.split(x, "[–-]"), F.lit(0)), F.get(F.split(x, "[–-]"), F.lit(1))
        plain = char_range(a, b)
        if kind is not None:
            numerals = char_range(F.lower(a), F.lower(b), roman_first=True)
            plain = F.when(kind == "roman", F.when(a == F.lower(a), numerals).otherwise(F.transform(numerals, lambda n: F.upper(n)))).otherwise(plain)
        return F.when(F.size(F.split(x, "[–-]")) == 2, plain).otherwise(F.array(x))

    out = F.array_sort(F.array_distinct(F.flatten(F.transform(pieces, one))))
    return out if kind is None else F.when(kind == "position", F.array_sort(F.array_distinct(words))).otherwise(out)


def _implied(rows: DataFrame) -> Column:
    return implied_labels(F.col("span"), F.col("kind") if "kind" in rows.columns else None)


def position_labels(words: DataFrame, column: str = "label") -> DataFrame:
    """Labels that are words of position."""
    return words.where(F.lower(column).isin(*POSITIONS))


def suggested_labels(spans: DataFrame, key: str) -> DataFrame:
    """The set of labels of each caption, sorted."""
    return spans.select(key, F.explode(_implied(spans)).alias("l")).groupBy(key).agg(F.array_sort(F.collect_set("l")).alias("labels"))


def likely_label(label: Column, suggested: Column, text: Column) -> Column:
    """A letter that fits the suggested ones: before the last, next to one, or in brackets with one and no digit."""
    others = F.filter(suggested, lambda x: (F.lower(x) != F.lower(label)) & F.lower(x).rlike("^[a-z]$"))
    at = F.ascii(F.lower(label))
    within = F.coalesce(F.array_max(F.transform(others, lambda x: F.ascii(F.lower(x)))) > at, F.lit(False))
    beside = F.exists(others, lambda x: F.abs(F.ascii(F.lower(x)) - at) == 1)
    groups = F.transform(F.regexp_extract_all(text, F.lit(r"(\([^)]*\))"), F.lit(1)), lambda g: F.filter(F.split(F.regexp_replace(g, r"[^\w\s]", " "), " "), lambda x: ~x.isin("and", "")))
    mine = F.filter(groups, lambda g: F.array_contains(g, label))
    joined = F.exists(mine, lambda g: F.arrays_overlap(g, others)) & ~F.exists(mine, lambda g: F.exists(g, lambda x: x.rlike("^[0-9]+$")))
    return F.lower(label).rlike("^[a-z]$") & (within | beside | joined)


def require_a(labels: Column) -> Column:
    """Letters have to include a, else the caption is one subfigure, "0" (C11)."""
    return F.when(F.array_contains(labels, "a") | F.array_contains(labels, "A") | ~F.exists(labels, lambda x: x.rlike("^[A-Za-z]$")), labels).otherwise(F.array(F.lit("0")))


def subfigure_count(spans: DataFrame, key: str) -> DataFrame:
    """(C12)"""
    return spans.select(key, F.explode(_implied(spans)).alias("l")).groupBy(key).agg(F.count_distinct("l").alias("n"))


def subfigure_labels(spans: DataFrame, key: str) -> DataFrame:
    """The caption's spans in order, as it writes them."""
    return spans.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "span"))), lambda x: x["span"]).alias("labels"))


def _let(value: Column, body) -> Column:
    """body of the value, which is computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repair_semicolons(text: Column, trigger: str, stop: str) -> Column:
    """Where semicolons part the text more often than full stops do, those behind the parts from the one with the trigger to
    the last with the stop (the end, where none has it) become commas, and those behind parts that read the same; without
    a trigger, those behind parts that read as the last does (C16)."""

    def glued(t: Column, parts: Column, within: Column) -> Column:
        ends = F.transform(parts, lambda p, i: F.concat(p, F.when(i + 1 == F.size(parts), F.lit("")).when(F.array_contains(within, p), F.lit(", ")).otherwise(F.lit("; "))))
        return F.when(F.size(parts) > F.size(F.split(t, r"\. ")), F.array_join(ends, "")).otherwise(t)

    def between(parts: Column, first: Column) -> Column:
        last = F.coalesce(F.array_max(F.transform(parts, lambda p, i: F.when(F.contains(p, F.lit(stop)) & (i + 1 >= first), i + 1))), F.size(parts))
        return F.when(first > 0, F.slice(parts, F.greatest(first, F.lit(1)), last - first + 1)).otherwise(F.slice(parts, -1, 1))

    def cut(t: Column, parts: Column) -> Column:
        first = F.array_position(F.transform(parts, lambda p: F.contains(p, F.lit(trigger))), True).cast("int")
        return _let(_let(first, lambda k: between(parts, k)), lambda within: glued(t, parts, within))

    return _let(text, lambda t: _let(F.split(t, "; "), lambda parts: cut(t, parts)))


# Sequences that are written otherwise before a caption is read.
SUBSTITUTES = [(")-(", "-"), (")–(", "–"), (":(", ": ("), ("):", ") :")]
PHRASES = [(". From left to right: (a)", ": (a)"), ("of image (", "shown in image ("), ("(a) :", ": (a)"), ("1 –", "1 -"), ("2 –", "2 -"), ("3 –", "3 -"), ("N-C.", "N-C ."), (". ", " . "), (". (a)", " (a)")]


def normalize_caption(text: Column) -> Column:
    """One form of brackets, spaces and full stops; a leading "a " becomes "(a)"; the end gets a full stop (C14)."""
    for a, b in SUBSTITUTES:
        text = F.replace(text, F.lit(a), F.lit(b))
    text = F.regexp_replace(text, " +", " ")
    text = repair_semicolons(repair_semicolons(text, "images of", " ."), "with precipitates", " .")
    for a, b in PHRASES:
        text = F.replace(text, F.lit(a), F.lit(b))
    text = F.when(F.substr(text, F.lit(1), F.lit(2)).isin("a ", "A "), F.concat(F.lit("("), F.left(text, F.lit(1)), F.lit(")"), F.substr(text, F.lit(2)))).otherwise(text)
    return F.when(F.right(text, F.lit(1)) == ".", text).otherwise(F.concat(text, F.lit(" .")))


def segments(caps: DataFrame, key: str, text: str = "caption", delimiter: str | None = None) -> DataFrame:
    """key, seq, kind, span, segment: the text that belongs to each run of labels of the kind that delimits its caption, as
    told by the column delimiter or else by the caption's spans (C15)."""
    found = caps.select(key, F.col(text).alias("_t"), *([F.col(delimiter).alias("_d")] if delimiter else []), span_array(F.col(text)).alias("_s"))
    if not delimiter:
        found = found.withColumn("_d", delimiter_of(F.col("_s")))
    own = found.withColumn("_s", F.filter("_s", lambda s: (s["kind"] == F.col("_d")) & ~s["refers"]))

    def piece(a: Column | None, b: Column | None) -> Column:
        """The text behind the span a (the beginning, without one) to the span b (the end)."""
        begin = F.lit(1) if a is None else F.coalesce(a["pos"] + F.length(a["span"]), F.lit(1))
        end = F.length("_t") + 1 if b is None else F.coalesce(b["pos"], F.length("_t") + 1)
        return F.substring("_t", begin, end - begin)

    head, tail = piece(None, F.get("_s", F.lit(0))), piece(F.try_element_at("_s", F.lit(-1)), None)
    trailing = (F.trim(head) != "") & (F.trim(F.translate(tail, ".", " ")) == "")
    rows = own.withColumn("_trailing", trailing).select(key, "_t", "_s", "_trailing", F.posexplode("_s").alias("seq", "_l"))
    before, after = F.when(F.col("seq") > 0, F.get("_s", F.col("seq") - 1)), F.get("_s", F.col("seq") + 1)
    return rows.select(key, "seq", "_l.kind", "_l.span", F.trim(F.when(F.col("_trailing"), piece(before, F.col("_l"))).otherwise(piece(F.col("_l"), after))).alias("segment"))


def preamble(text: Column, delimiter: Column | None = None) -> Column:
    """What stands before the first label of the kind that delimits the caption."""

    def cut(found: Column) -> Column:
        first = F.array_min(F.transform(F.filter(found, lambda s: (s["kind"] == (delimiter_of(found) if delimiter is None else delimiter)) & ~s["refers"]), lambda s: s["pos"]))
        return F.trim(F.coalesce(F.left(text, first - 1), text))

    return _let(span_array(text), cut)


def _pairs(df: DataFrame, group: str, order: str, text: str) -> DataFrame:
    a = df.select(group, F.col(order).alias("i"), F.col(text).alias("a"))
    b = df.select(group, F.col(order).alias("j"), F.col(text).alias("b"))
    return a.join(b, group).where("i < j")


def prune_similar(df: DataFrame, group: str, order: str, text: str, most: float) -> DataFrame:
    """Of two texts of a group whose matching-blocks ratio is `most` or more, the shorter goes, the later of equals (C17)."""
    return df.join(matched_rows(df, group, order, text, most), [group, order], "left_anti")


def prune_similar_native(df: DataFrame, group: str, order: str, text: str, most: float) -> DataFrame:
    """The same by edit distance over the longer text's length, with Spark's own functions (C17)."""
    near = 1 - F.levenshtein("a", "b") / F.greatest(F.length("a"), F.length("b"), F.lit(1))
    return _drop_shorter(df, _pairs(df, group, order, text).where(near >= most), group, order)


def _drop_shorter(df, near, group, order):
    gone = near.select(group, F.when(F.length("a") < F.length("b"), F.col("i")).otherwise(F.col("j")).alias(order)).distinct()
    return df.join(gone, [group, order], "left_anti")


def clean_segment(text: Column) -> Column:
    """Without the label it begins with, in any of its forms, and the punctuation around it."""
    run = rf"\w(?:{_JOINERS}\w)*"
    label = rf"^\s*(?:\([^()]*\)|:{run}:|[(:]{run}\b|{run}[):]|\. {run}\b)\s*"
    return F.regexp_replace(F.regexp_replace(text, label, ""), r"^[\s.,;:]+|[\s.,;:]+$", "")


def drop_shared_text(segs: DataFrame, key: str) -> DataFrame:
    """Without segments that hold another label's whole segment.

    A caption's segments come to one row, where they are compared: they are made once, and no pairs are written out."""
    rows = segs.groupBy(key).agg(F.collect_list(F.struct(*(F.col(c) for c in segs.columns if c != key))).alias("_all"))
    texts = F.array_distinct(F.transform(F.filter("_all", lambda x: (x["segment"] != "") & x["seq"].isNotNull()), lambda x: F.struct(x["seq"].alias("seq"), x["segment"].alias("segment"))))
    held = lambda x: F.exists("_texts", lambda t: (t["seq"] != x["seq"]) & F.contains(x["segment"], t["segment"]))
    kept = rows.withColumn("_texts", texts).select(key, F.explode(F.filter("_all", lambda x: F.col(key).isNull() | ~F.coalesce(held(x), F.lit(False)))).alias("_x"))
    return kept.select(*(F.col(c) if c == key else F.col(f"_x.{c}").alias(c) for c in segs.columns))


def tag(df: DataFrame, key: str, text: str, terms: dict[str, list[str]] | DataFrame, skip_empty: bool = True) -> DataFrame:
    """key, term of every term one of whose synonyms the text holds, case as written.

    terms is a dictionary or a table (term, synonym); all synonyms are looked for in one pass. An empty synonym is held by
    every text unless skip_empty."""
    table = terms if isinstance(terms, DataFrame) else df.sparkSession.createDataFrame([(t, s) for t, syn in terms.items() for s in syn], "term string, synonym string")
    found = with_held(df.select(key, F.col(text).alias("_text")), "_text", table.select(F.col("synonym").alias("pattern"), F.col("term").alias("label")), "_held")
    if not skip_empty:
        always = F.array(*(F.lit(r["term"]) for r in table.where("synonym = '' and term is not null").select("term").distinct().collect())).cast("array<string>")
        found = found.withColumn("_held", F.when(F.col("_text").isNotNull(), F.array_union("_held", always)))
    return found.select(key, F.explode("_held").alias("term"))


def fan_out(segs: DataFrame, key: str) -> DataFrame:
    """One row a label that a span implies, each text once."""
    return segs.select(key, F.explode(_implied(segs)).alias("label"), "segment").distinct()


def unique_remainder(segs: DataFrame, key: str) -> DataFrame:
    """Each segment without the longest earlier segment of the caption that it holds."""
    before = F.collect_list("segment").over(Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    held = F.filter(before, lambda t: (t != "") & F.contains("segment", t))
    best = F.element_at(F.array_sort(F.transform(held, lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t")))), 1)["t"]
    return segs.withColumn("_b", before).withColumn("remainder", F.when(F.size(held) > 0, F.trim(F.replace(F.col("segment"), best, F.lit("")))).otherwise(F.col("segment"))).drop("_b")


def propagate_keywords(rows: DataFrame, key: str) -> DataFrame:
    """Keywords (arrays) of all rows of a label, each once, sorted."""
    return rows.groupBy(key, "label").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("keywords")))).alias("keywords"))


def distribute(figures: DataFrame, segs: DataFrame, kinds: DataFrame, key: str) -> DataFrame:
    """figures with their delimiter and caption entries in order, an empty list where there are none."""
    entries = segs.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("seq", "span", "segment"))).alias("entries"))
    out = figures.join(kinds, key, "left").join(entries, key, "left")
    return out.withColumn("entries", F.coalesce("entries", F.array().cast(entries.schema["entries"].dataType)))
