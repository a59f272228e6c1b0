"""Faceted search over the result tables; every facet is a filter or semi-join that Catalyst orders and pushes down."""

import functools
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from figloom.operators import trigrams


@dataclass
class Tables:
    article: DataFrame
    figure: DataFrame
    subfigure: DataFrame
    scale_bar: DataFrame
    scale_label: DataFrame


@dataclass
class Params:
    """What a search asks for; None and empty leave a facet out."""

    classes: list[str] = field(default_factory=list)
    open: bool | None = None
    min_scale: float | None = None
    max_scale: float | None = None
    confidence: float = 0.3
    keywords: list[str] = field(default_factory=list)
    keyword_fields: list[str] = field(default_factory=lambda: ["caption", "full_caption", "title"])


def by_class(subfigures: DataFrame, codes: list[str]) -> DataFrame:
    """(H1)"""
    return subfigures.where(F.col("classification_code").isin(*codes))


def by_open(subfigures: DataFrame, figures: DataFrame, articles: DataFrame, is_open: bool) -> DataFrame:
    """Subfigures of articles that are (or aren't) open (H2)."""
    wanted = figures.join(articles.where(F.col("open") == is_open).select(F.col("doi").alias("article_id")), "article_id", "left_semi").select("figure_id")
    return subfigures.join(wanted, "figure_id", "left_semi")


def by_scale(subfigures: DataFrame, least: float | None, most: float | None) -> DataFrame:
    """Physical width from least on and below most (H3)."""
    out = subfigures if least is None else subfigures.where(F.col("nm_width") >= least)
    return out if most is None else out.where(F.col("nm_width") < most)


def by_scale_confidence(subfigures: DataFrame, bars: DataFrame, labels: DataFrame, above: float) -> DataFrame:
    """Subfigures with a bar whose label was read with more confidence (H4)."""
    sure = bars.join(labels.where(F.col("label_confidence") > above).select("scale_bar_id"), "scale_bar_id", "left_semi")
    return subfigures.join(sure.select("subfigure_id"), "subfigure_id", "left_semi")


def by_keyword(subfigures: DataFrame, figures: DataFrame, articles: DataFrame, keywords: list[str], fields: list[str]) -> DataFrame:
    """Any keyword, whatever the case, in any of the fields caption, full_caption, title (H5)."""
    if not fields:
        return subfigures
    out = subfigures
    if "full_caption" in fields or "title" in fields:
        out = out.join(figures.select("figure_id", F.col("caption").alias("full_caption"), "article_id"), "figure_id", "left")
    if "title" in fields:
        out = out.join(articles.select(F.col("doi").alias("article_id"), "title"), "article_id", "left")
    hit = F.lit(False)
    for f in fields:
        for k in keywords:
            hit = hit | F.coalesce(F.contains(F.lower(f), F.lit(k.lower())), F.lit(False))
    return out.where(hit).select(*subfigures.columns)


def index_tables(t: Tables, path: str, buckets: int = trigrams.BUCKETS) -> dict[str, trigrams.TextIndex]:
    """Trigram indexes of the fields that keywords are looked for in, written under path."""
    fields = {"caption": (t.subfigure, "subfigure_id", "caption"), "full_caption": (t.figure, "figure_id", "caption"), "title": (t.article, "doi", "title")}
    return {f: trigrams.build(df, key, text, f"{path}/{f}", buckets) for f, (df, key, text) in fields.items()}


def by_indexed_keyword(subfigures: DataFrame, figures: DataFrame, keywords: list[str], fields: list[str], indexes: dict[str, trigrams.TextIndex]) -> DataFrame:
    """As by_keyword, from stored trigram indexes: captions that can't hold a keyword aren't read (H5)."""
    if not fields:
        return subfigures
    hits = {f: functools.reduce(DataFrame.union, [indexes[f].holding(k) for k in keywords]).distinct() for f in fields}
    found = []
    if "caption" in hits:
        found.append(hits["caption"].select(F.col("id").alias("subfigure_id")))
    own = []
    if "full_caption" in hits:
        own.append(hits["full_caption"].select(F.col("id").alias("figure_id")))
    if "title" in hits:
        own.append(figures.join(hits["title"].select(F.col("id").alias("article_id")), "article_id", "left_semi").select("figure_id"))
    if own:
        found.append(subfigures.join(functools.reduce(DataFrame.union, own), "figure_id", "left_semi").select("subfigure_id"))
    return subfigures.join(functools.reduce(DataFrame.union, found), "subfigure_id", "left_semi")


def search(t: Tables, p: Params, indexes: dict[str, trigrams.TextIndex] | None = None) -> DataFrame:
    """All facets asked for, in order of subfigure_id; keywords by the indexes where there are any (H6)."""
    out = by_class(t.subfigure, p.classes) if p.classes else t.subfigure
    if p.min_scale is not None or p.max_scale is not None:
        out = by_scale(out, p.min_scale, p.max_scale)
        out = by_scale_confidence(out, t.scale_bar, t.scale_label, p.confidence)
    if p.open is not None:
        out = by_open(out, t.figure, t.article, p.open)
    if p.keywords and indexes:
        out = by_indexed_keyword(out, t.figure, p.keywords, p.keyword_fields, indexes)
    elif p.keywords:
        out = by_keyword(out, t.figure, t.article, p.keywords, p.keyword_fields)
    return out.orderBy("subfigure_id")


def page_of(results: DataFrame, order: str, size: int, number: int) -> DataFrame:
    """One page (from 1) of the results (H7)."""
    return results.orderBy(order).offset(size * (number - 1)).limit(size)


def page_count(results: DataFrame, size: int) -> DataFrame:
    return results.agg(F.count("*").alias("n"), F.ceil(F.count("*") / size).alias("pages"))


def grid_columns(page: DataFrame, order: str, columns: int) -> DataFrame:
    """Row i of a page goes to column i mod columns; a page is small, so one window orders it (H8)."""
    return page.withColumn("grid_column", ((F.row_number().over(Window.orderBy(order)) - 1) % columns).cast("int"))


def detail_view(subfigures: DataFrame, figures: DataFrame, articles: DataFrame) -> DataFrame:
    """Results with what a reader sees of figure and article (H9)."""
    out = subfigures.join(figures.select("figure_id", F.col("url").alias("image_url"), "article_id"), "figure_id")
    return out.join(articles.select(F.col("doi").alias("article_id"), "title", F.col("url").alias("article_url"), "license", "open"), "article_id")
