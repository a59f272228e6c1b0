r"""Quality rules: text measures and a learned decision list, with Spark expressions only.

Words are runs of other characters than space and \t \n \v \f \r. The measures of every labelled text are cut into
bins, and the bins' label counts are all that learning sees: rules are grown one condition at a time by information
gain on two thirds of the texts, pruned on the rest, and what a rule covers is taken away before the next one
(sequential covering). The list comes out as one conditional expression; its first rule that fits decides.

Null texts have no words; all measures of texts without words are 0 and the shares that rules look at are 0. Labels
other than 0 and 1 and null labels are left out; without labels of both kinds no rule is learned and the base decides
alone. Repeated rows are judged alike and kept; the first rule that fits decides, and of equally good conditions the first
is taken. An empty table gives an empty result; texts may be of any length and are measured to their end. Only doc_id and
text are read, so other columns make no difference.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figloom.functions.session import materialise

WHITE = " \t\n\x0b\x0c\r"
_POSITION_BITS = 22

#: What rules look at: name -> share of the measures.
SHARES = {
    "symbol_share": "n_symbols / word_chars",
    "upper_share": "n_upper / word_chars",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "word_length": "word_chars / n_words",
    "words": "n_words",
}
BINS = 8


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in 3-word windows that are found twice or more in the text: windows are sorted by hash, those whose hash has a
    neighbour are sorted by their words and compared, and the covered words of the positions left are counted."""
    mask = (1 << _POSITION_BITS) - 1

    def key(i):
        return F.shiftleft(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), _POSITION_BITS).bitwiseOR(i)

    def near(keys):
        return F.filter(keys, lambda c, j: (F.shiftrightunsigned(c.bitwiseXOR(F.get(keys, j + 1)), _POSITION_BITS) == 0) | (F.shiftrightunsigned(c.bitwiseXOR(F.get(keys, j - 1)), _POSITION_BITS) == 0))

    def at(c):
        return c.bitwiseAND(F.lit(mask)).cast("int")

    def window(p):
        return F.struct(F.get(words, p).alias("a"), F.get(words, p + 1).alias("b"), F.get(words, p + 2).alias("c"), p.alias("p"))

    def same(x, y):
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    def repeated(windows):
        return F.array_sort(F.transform(F.filter(windows, lambda x, j: same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1))), lambda x: x["p"]))

    def covered(places):
        return F.aggregate(F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)

    def let(value, body):
        return F.element_at(F.transform(F.array(value), body), 1)

    index = F.sequence(F.lit(0).cast("long"), (n - 3).cast("long"))
    short = let(F.sort_array(F.transform(index, key)), lambda k: F.transform(near(k), at))
    # Texts of more words than positions fit in a key are sorted by their words at once.
    places = F.when(n - 2 <= mask, short).otherwise(index.cast("array<int>"))
    return F.when(n < 3, F.lit(0).cast("long")).otherwise(let(F.sort_array(F.transform(places, window)), lambda w: let(repeated(w), covered)))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs' doc_id with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines of the whole text."""
    whole = docs.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias("_x"))
    cut = whole.withColumn("_t", F.btrim("_x", F.lit(WHITE))).withColumn("_w", F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(F.split("_t", r"[\x20\x09-\x0D]+")))
    cut = cut.withColumn("_l", F.filter(F.split("_x", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("_w")

    def left(of):
        return F.length(F.regexp_replace("_t", of, "")).cast("long")

    return cut.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        left(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_w"), n).alias("n_repeat_words"),
        left(r"[^\p{Lu}]+").alias("n_upper"),
        F.size("_l").cast("long").alias("n_lines"),
    )


def shares(measured: DataFrame) -> DataFrame:
    """Adds the shares that rules look at; 0 where nothing is counted."""
    return measured.withColumns({k: F.coalesce(F.expr(f"try_divide({v.split(' / ')[0]}, {v.split(' / ')[1]})") if " / " in v else F.col(v).cast("double"), F.lit(0.0)) for k, v in SHARES.items()})


def _cells(labelled: DataFrame) -> tuple[dict[str, list[float]], list[tuple[tuple[int, ...], bool, int, int]]]:
    """Cut points of each share, and the label counts of each occupied combination of bins: (bins, for pruning, bad, good).

    BINS ** len(SHARES) combinations at most, whatever the corpus."""
    at = [i / BINS for i in range(1, BINS - 1)] + [0.95]
    points = labelled.agg(*(F.percentile_approx(k, at, 5000).alias(k) for k in SHARES)).first()
    cuts = {k: sorted(set(points[k] or [])) for k in SHARES}

    def bin_of(k):
        return sum((F.when(F.col(k) > c, 1).otherwise(0) for c in cuts[k]), F.lit(0)).cast("int").alias(f"b_{k}")

    held = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("held")
    counts = labelled.groupBy(*(bin_of(k) for k in SHARES), held).agg(F.sum(1 - F.col("quality")).alias("bad"), F.sum("quality").alias("good"))
    return cuts, [(tuple(r[f"b_{k}"] for k in SHARES), r["held"], r["bad"], r["good"]) for r in counts.collect()]


def learn(cuts: dict[str, list[float]], cells: list, least_precision: float = 0.8, most_rules: int = 12) -> list[list[tuple[str, str, float]]]:
    """Rules for bad texts, in order; each is a list of (share, '>' or '<=', threshold). Ties go to the first candidate."""
    names = list(cuts)
    candidates = [(f, op, b) for f, k in enumerate(names) for b in range(len(cuts[k])) for op in (">", "<=")]

    def fits(bins, rule):
        return all((bins[f] > b) == (op == ">") for f, op, b in rule)

    def total(part):
        return sum(c[2] for c in part), sum(c[3] for c in part)

    rules, left = [], cells
    while len(rules) < most_rules:
        grow, prune = [c for c in left if not c[1]], [c for c in left if c[1]]
        rule, inside = [], grow
        bad, good = total(grow)
        while bad and good and len(rule) < 4:
            best = (1e-9, None, None)
            for c in candidates:
                part = [x for x in inside if fits(x[0], [c])]
                p, q = total(part)
                if p and (gain := p * (math.log2(p / (p + q)) - math.log2(bad / (bad + good)))) > best[0]:
                    best = (gain, c, part)
            if best[1] is None:
                break
            rule, inside = [*rule, best[1]], best[2]
            bad, good = total(inside)

        def worth(r):
            p, q = total([c for c in prune if fits(c[0], r)])
            return (p - q) / (p + q) if p + q else -1.0

        if rule:
            rule = rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k]), -k))]
        p, q = total([c for c in prune if fits(c[0], rule)]) if rule else (0, 0)
        if p < 3 or p / (p + q) < least_precision:
            break
        rules.append(rule)
        left = [c for c in left if not fits(c[0], rule)]
    return [[(names[f], op, cuts[names[f]][b]) for f, op, b in r] for r in rules]


def as_text(rule: list[tuple[str, str, float]]) -> str:
    return " and ".join(f"{k} {op} {t!r}" for k, op, t in rule)


def decision(rules: list[list[tuple[str, str, float]]]) -> Column:
    """The first rule that fits, as text; null where none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(F.expr(" and ".join(f"{k} {op} {t!r}D" for k, op, t in rule)), F.lit(as_text(rule))).otherwise(out)
    return out


def fit_and_judge(docs: DataFrame, labels: DataFrame, least_words: int = 50) -> DataFrame:
    """Measures of every row of docs with base_failed, rule (the learned rule that fits) and kept; labels has doc_id, quality."""
    measured = materialise(shares(measures(docs)))
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    learned = learn(*_cells(measured.join(known, "doc_id")))
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", base).withColumn("rule", decision(learned)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
