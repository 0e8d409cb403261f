"""Page HTML and request URLs: attribute extraction and name lists.

Everything is ``regexp_extract`` / ``parse_url`` on columns, so pages are
processed where they sit, one row at a time inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# One token of a page: a comment, a declaration or CDATA section, a script or style element with all it
# holds, or a tag whose quoted values may hold anything. Group 1 is the token if it is a meta tag. Tokens
# are consumed one after the other, so text in comments, scripts and attribute values is never taken for a tag.
_IN_TAG = r"""(?:[^>"']++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))*+"""
_TOKEN = "".join((
    r"(?is)<!--(?:>|->|.*?(?:--!?>|\z))", r"|<!\[CDATA\[.*?(?:\]\]>|\z)", r"|<[!?][^>]*+>?",
    rf"|<(?:script|style)(?=[\s/>]){_IN_TAG}>.*?(?:</(?:script|style)\s*+>|\z)",
    rf"|(<meta(?=[\s/>]){_IN_TAG}>)", rf"|</?[a-z]{_IN_TAG}>",
))
# Character references of attribute values; the ampersand comes last, so that nothing is decoded twice.
_ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def _attribute(tag: Column, attr: str) -> Column:
    """Decoded value of an attribute of one tag, in double quotes, single quotes or bare; NULL when absent or empty."""
    start = rf"(?i)\s{attr}\s*=\s*"
    forms = (start + r'"([^"]*)"', start + r"'([^']*)'", start + r"""([^\s"'>]+)""")
    value = F.coalesce(*[F.nullif(F.regexp_extract(tag, form, 1), F.lit("")) for form in forms])
    for entity, char in _ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def meta_content(html: Column | str, value: str, attr: str = "property") -> Column:
    """``content`` of the first ``<meta>`` tag whose ``attr`` is ``value`` (attributes in any
    order, any quoting, character references decoded); NULL when absent or empty. Tags in
    comments, scripts, styles, CDATA sections and attribute values don't count."""
    tags = F.regexp_extract_all(_col(html), F.lit(_TOKEN), F.lit(1))
    tag = F.get(F.filter(tags, lambda t: (t != "") & (F.lower(_attribute(t, attr)) == value.lower())), 0)
    return _attribute(tag, "content")


def html_lang(html: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(html), r'<html[^>]*\slang="([^"]*)"', 1), F.lit(""))


def html_title(html: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(html), r"<title>([^<]*)</title>", 1), F.lit(""))


def html_charset(html: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(html), r'<meta[^>]*\scharset="([^"]*)"', 1), F.lit(""))


def extract_meta(
    pages: DataFrame,
    value: str = "og:image",
    html_col: str = "html",
    url_col: str = "url",
    name_col: str = "name",
    tag: str = "og_image",
    limit: int | None = None,
    extracted_at=None,
) -> DataFrame:
    """Rows ``(name, image_url, source)`` for pages with a non-empty url and
    name whose meta tag has content. ``limit`` caps the number of *hits* (a
    per-run quota): the first by name and image; default: no cap. With
    ``extracted_at`` the rows also carry that extraction time."""
    present = (F.coalesce(F.col(url_col), F.lit("")) != "") & (F.coalesce(F.col(name_col), F.lit("")) != "")
    hits = pages.filter(present).select(
        F.col(name_col).alias("name"),
        meta_content(html_col, value).alias("image_url"),
        F.lit(tag).alias("source"),
    ).filter(F.col("image_url").isNotNull())
    if extracted_at is not None:
        hits = hits.withColumn("extracted_at", F.lit(extracted_at).cast("timestamp"))
    return hits.orderBy("name", "image_url").limit(limit) if limit is not None else hits


def url_param(url: Column | str, key: str) -> Column:
    """Decoded value of query parameter ``key`` (NULL when absent)."""
    return F.url_decode(F.parse_url(_col(url), F.lit("QUERY"), F.lit(key)))


def names_from_url(df: DataFrame, url_col: str, key: str = "market_hash_name", keep: tuple = ()) -> DataFrame:
    """Comma-joined names of a query parameter -> one row per name (trimmed, non-empty)."""
    return (
        df.select(*keep, F.explode(F.split(url_param(url_col, key), ",")).alias("name"))
        .select(*keep, F.trim("name").alias("name"))
        .filter(F.col("name") != "")
    )



def item_images(
    items: DataFrame,
    pages: DataFrame,
    name_col: str = "market_hash_name",
    page_col: str = "item_page",
    url_col: str = "url",
    html_col: str = "html",
    limit: int | None = None,
    extracted_at=None,
) -> DataFrame:
    """Image rows for items: each item's page (matched on its page URL in a
    table of stored pages) -> its ``og:image``. Items without a name or page,
    and pages without the tag, give no row; a URL stored twice gives its
    least image. ``limit`` caps the hits (the first by name and image).

    The image is extracted where the page is read, so one short string per
    URL is shuffled and never the HTML."""
    images = (pages.select(url_col, meta_content(html_col, "og:image").alias("image_url"))
              .filter(F.col("image_url").isNotNull()).groupBy(url_col).agg(F.min("image_url").alias("image_url")))
    wanted = items.select(F.col(name_col).alias("name"), F.col(page_col).alias(url_col)).filter(
        (F.coalesce("name", F.lit("")) != "") & (F.coalesce(F.col(url_col), F.lit("")) != ""))
    hits = wanted.join(images, on=url_col, how="inner").select("name", "image_url", F.lit("og_image").alias("source"))
    if extracted_at is not None:
        hits = hits.withColumn("extracted_at", F.lit(extracted_at).cast("timestamp"))
    return hits.orderBy("name", "image_url").limit(limit) if limit is not None else hits
