"""Article search and extraction over stored pages: nodes of the html column, regular expressions where a page's text is
enough, joins to small family tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from figloom.operators import html as hp

# How each journal family's site builds addresses.
FAMILIES = [
    ("acs", "https://pubs.acs.org", '/action/doSearch?AllField="', '"+"', '"&publication=&accessType=allContent&Earliest=&pageSize=20&startPage=0&sortBy=', '"&publication=&openAccess=18&accessType=openAccess&Earliest=&pageSize=20&startPage=0&sortBy=', "", "/doi/", "https://pubs.acs.org"),
    ("nature", "https://www.nature.com", '/search?q="', '"%20"', '"&order=', '"&order=', "&page=1", "/articles/", ""),
    ("rsc", "https://pubs.rsc.org", "/en/results?searchtext=", '"%20"', '"&SortBy=', '"&SortBy=', "&PageSize=1&tab=all&fcategory=all&filter=all&Article%20Access=Open+Access", "/en/content/articlehtml/", "https://pubs.rsc.org"),
]
FAMILY_SCHEMA = "family string, domain string, path string, join string, sort_part string, open_part string, tail string, article_path string, prepend string"
#: What stands in the links of an RSC figure's image.
IMAGE_KEY = "/image/article"
#: What marks a figure of ACS that has a caption.
ACS_FIGURE = "inline-fig internalNav"
#: Path segments of reader versions of an article.
READERS = ["abs", "full", "pdf"]


def expand_terms(fields: list[DataFrame]) -> DataFrame:
    """All combinations of one term of each field; each frame has one column, and their product is the wanted result (B1)."""
    out = fields[0]
    for f in fields[1:]:
        out = out.crossJoin(f)
    return out


def search_urls(terms: DataFrame, families: DataFrame, columns: list[str], order: str, open_only: bool = False) -> DataFrame:
    """Adds url: the family's template around the terms, spaces as +; the part for open articles where only these are wanted (B2)."""
    joined = F.concat_ws("\x01", *(F.regexp_replace(c, " ", "+") for c in columns))
    part = "open_part" if open_only else "sort_part"
    return terms.join(F.broadcast(families), "family").withColumn("url", F.concat("domain", "path", F.replace(joined, F.lit("\x01"), F.col("join")), part, F.lit(order), "tail"))


def paginate(urls: DataFrame, family: Column | None = None, size: Column | None = None) -> DataFrame:
    """One row a result page from `first` to `last`, with its address; RSC shows all `size` results on one page."""
    out = urls.withColumn("page", F.explode(F.sequence("first", "last")))
    family, number = F.lit("nature") if family is None else family, F.col("page").cast("string")
    acs = F.concat(F.split_part("url", F.lit("&startPage="), F.lit(1)), F.lit("&startPage="), number, F.lit("&pageSize=20"))
    rsc = F.concat(F.split_part("url", F.lit("1&tab=all"), F.lit(1)), (F.lit(1) if size is None else size).cast("string"), F.lit("&tab=all&fcategory=all&filter=all&Article%20Access=Open+Access"))
    nature = F.concat(F.split_part("url", F.lit("&page="), F.lit(1)), F.lit("&page="), number)
    return out.withColumn("page_url", F.when(family == "acs", acs).when(family == "rsc", rsc).otherwise(nature))


def data_layer(html: Column) -> Column:
    """The object inside the script's `[{...}];`, as JSON text; empty without one."""
    return F.regexp_extract(html, r"(?s)\[(\{.*?\})\];", 1)


def page_info(html: Column, family: str) -> dict[str, Column]:
    """page, total_pages, total_results."""
    if family == "nature":
        return {k: F.get_json_object(data_layer(html), f"$.page.search.{n}").cast("int") for k, n in (("page", "page"), ("total_pages", "totalPages"), ("total_results", "totalResults"))}
    if family == "acs":
        n = F.regexp_extract(html, r'class="result__count">([0-9]+)<', 1).try_cast("int")
        return {"page": F.lit(0), "total_pages": F.ceil(n / 20.0).cast("int") - 1, "total_results": n}
    text = F.substring_index(F.regexp_replace(html, "<[^>]*>", ""), " - Showing page 1 of", 1)
    numbers = F.filter(F.split(F.element_at(F.split(text, "Back to tab navigation"), -1), " "), lambda x: F.trim(x, F.lit("\n")).rlike("^[0-9]+$"))
    n = F.when(F.size(numbers) == 1, F.trim(F.get(numbers, F.lit(0)), F.lit("\n")).try_cast("int"))
    return {"page": F.lit(1), "total_pages": F.lit(1), "total_results": F.coalesce(n, F.lit(0))}


def article_links(pages: DataFrame, article_path: str) -> DataFrame:
    """Links of each page that lead to articles, cut before `?page=search`."""
    links = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'<a [^>]*href="([^"]*)"'), F.lit(1))).alias("link"))
    return links.withColumn("link", F.substring_index("link", "?page=search", 1)).where(F.contains("link", F.lit(article_path)))


def drop_reader_links(links: DataFrame, readers: list[str] = READERS) -> DataFrame:
    """Without links to reader versions."""
    return links.where(~F.arrays_overlap(F.split("link", "/"), F.array(*map(F.lit, readers))))


def last_segment(link: Column) -> Column:
    return F.element_at(F.split(link, "/"), -1)


def unvisited(links: DataFrame, ledger: DataFrame) -> DataFrame:
    """Links whose article isn't in the ledger (key)."""
    return links.withColumn("key", last_segment(F.col("link"))).join(ledger.select("key").distinct(), "key", "left_anti")


def open_links(pages: DataFrame) -> DataFrame:
    """Links whose third ancestor holds a badge that says Open."""
    nodes = pages.select("page_id", hp.tree(F.col("html")).alias("_n"))
    badges = F.filter(hp.elements(F.col("_n"), "span", "text-orange"), lambda b: hp.text_of(F.col("_n"), b) == "Open")
    links = nodes.withColumn("_b", badges).withColumn("_a", F.explode(hp.elements(F.col("_n"), "a"))).withColumn("link", hp.attribute(F.col("_a.attrs"), "href")).where("link != ''")

    def up(i: Column) -> Column:
        return F.when(i >= 0, F.get("_n", i)["parent"]).otherwise(-1)

    links = links.withColumn("_up", up(up(F.col("_a.parent"))))
    last = F.when(F.col("_up") >= 0, F.get("_n", F.col("_up"))["post"]).otherwise(F.size("_n"))
    return links.where(F.exists("_b", lambda b: (b["pre"] > F.col("_up")) & (b["pre"] <= last))).select("page_id", F.substring_index("link", "?page=search", 1).alias("link"))


def cap_links(links: DataFrame, n: int) -> DataFrame:
    """The first n different links in order."""
    return links.select("link").distinct().orderBy("link").limit(n)


def license_info(html: Column, family: str = "nature") -> dict[str, Column]:
    """open and license of an article: from the data layer, or from ACS's open-access badge; false and unknown without."""
    if family == "acs":
        badge = F.regexp_replace(F.regexp_extract(html, r'(?s)<div[^>]*class="article_header-open-access"[^>]*>(.*?)</div>', 1), "<[^>]*>", "")
        is_open = F.coalesce(F.contains(badge, F.lit("ACS AuthorChoice")) | F.contains(badge, F.lit("ACS Editors' Choice")), F.lit(False))
        return {"open": is_open, "license": F.when(is_open, badge).otherwise("unknown")}
    if family == "rsc":
        return {"open": F.lit(False), "license": F.lit("unknown")}
    j = data_layer(html)
    return {"open": F.coalesce(F.get_json_object(j, "$.content.attributes.copyright.open") == "true", F.lit(False)), "license": F.coalesce(F.get_json_object(j, "$.content.attributes.copyright.legacy.webtrendsLicenceType"), F.lit("unknown"))}


def figure_blocks(pages: DataFrame, key: str, family: str = "nature") -> DataFrame:
    """One row a figure block, numbered from 0: a figure element (ACS: with its mark), RSC's div of class image_table; one
    inside another is a block of its own, too (B12)."""
    nodes = pages.select(key, "html", hp.tree(F.col("html")).alias("_n"))
    hits = hp.elements(F.col("_n"), "div", "image_table") if family == "rsc" else hp.elements(F.col("_n"), "figure")
    blocks = F.transform(hits, lambda x: hp.outer(F.col("html"), x))
    if family == "acs":
        blocks = F.filter(blocks, lambda b: F.contains(b, F.lit(ACS_FIGURE)))
    return nodes.select(key, F.posexplode(blocks).alias("pos", "block"))


def captions(blocks: DataFrame, family: str = "nature") -> DataFrame:
    """Adds caption, the text of all its paragraphs (RSC: of its spans of class graphic_title); blocks without any are dropped."""
    n = F.col("_n")
    parts = hp.elements(n, "span", "graphic_title") if family == "rsc" else hp.elements(n, "p")
    told = blocks.withColumn("_n", hp.tree(F.col("block"))).withColumn("caption", F.array_join(F.transform(parts, lambda x: hp.text_of(n, x)), ""))
    return told.drop("_n").where("caption != ''")


def image_url(block: Column, prepend: str = "", family: str = "nature") -> Column:
    """Address of the block's image (RSC: of its last link to an image): no `_hi-res`, and a scheme."""
    if family == "rsc":
        links = F.filter(hp.elements(hp.tree(block), "a"), lambda a: hp.attribute(a["attrs"], "href").isNotNull() & F.contains(hp.outer(block, a), F.lit(IMAGE_KEY)))
        src = hp.attribute(F.try_element_at(links, F.lit(-1))["attrs"], "href")
    else:
        src = hp.attribute(F.get(hp.elements(hp.tree(block), "img"), F.lit(0))["attrs"], "src")
    src = F.concat(F.lit(prepend), F.replace(F.coalesce(src, F.lit("")), F.lit("_hi-res"), F.lit("")))
    return F.when(F.contains(src, F.lit(":")), src).otherwise(F.concat(F.lit("https:"), src))


def number_figures(blocks: DataFrame, article: str) -> DataFrame:
    """figure_no from 1 within the article and figure_name."""
    out = blocks.withColumn("figure_no", F.row_number().over(Window.partitionBy(article).orderBy("pos")))
    return out.withColumn("figure_name", F.concat(F.col(article).cast("string"), F.lit("_fig"), F.col("figure_no").cast("string"), F.lit(".jpg")))


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)


def figure_record(pages: DataFrame, key: str) -> DataFrame:
    """Figures of the pages as records with empty children."""
    out = number_figures(captions(figure_blocks(pages, key)), key).join(pages.select(key, page_title(F.col("html")).alias("title"), *(c.alias(k) for k, c in license_info(F.col("html")).items())), key)
    empty = F.array().cast("array<struct<label:string>>")
    return out.select(F.col(key).cast("string").alias("article_name"), "title", "open", "license", "figure_name", F.col("caption").alias("full_caption"), image_url(F.col("block")).alias("image_url"), empty.alias("master_images"), F.struct(empty.alias("captions")).alias("unassigned"))


def merge_figures(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Both, the new record where a key is in both."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def safe_extract(pages: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(pages with figures' counts, rejected pages with the reason): one bad page never stops the rest."""
    n = F.size(F.regexp_extract_all("html", F.lit(r"(?s)(<p[ >].*?</p>)"), F.lit(1)))
    out = pages.select(key, F.when(F.col("html").isNull(), "no page").when(page_title(F.col("html")) == "", "no title").when(n == 0, "no text").alias("_error"), n.cast("long").alias("n"))
    return out.where("_error is null").drop("_error"), out.where("_error is not null").select(key, F.col("_error").alias("reason"))
