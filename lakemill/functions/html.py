"""Features of raw HTML by regular expressions that run inside the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalars import col, filled
from lakemill.functions.urls import host_of

# Words that mark a call to action.
ACTION_WORDS = ("login", "sign in", "verify", "confirm", "submit", "continue", "unlock", "update")
MOST_ACTION_TEXTS = 20

_ACTION = r"""(?is)<(?:button|a)[^>]*>(.*?)</(?:button|a)>|<input[^>]+(?:value|aria-label)=['"]([^'"]+)['"]"""


def collapse(c: Column) -> Column:
    """White space to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def visible_text(html: Column | str) -> Column:
    """Markup out, white space collapsed; null if nothing is left."""
    return F.nullif(collapse(F.regexp_replace(col(html), "<[^>]+>", " ")), F.lit(""))


def title(html: Column | str) -> Column:
    return F.nullif(collapse(F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def document_language(html: Column | str) -> Column:
    found = F.lower(F.regexp_extract(col(html), r"""(?i)<html[^>]*\blang=['"]?([a-zA-Z_-]+)""", 1))
    return F.nullif(F.split_part(F.replace(found, F.lit("_"), F.lit("-")), F.lit("-"), F.lit(1)), F.lit(""))


def tag_count(html: Column | str, tag: str) -> Column:
    return F.regexp_count(col(html), F.lit(rf"(?i)<{tag}\b"))


def input_count(html: Column | str, kind: str) -> Column:
    return F.regexp_count(col(html), F.lit(rf"""(?i)<input[^>]+type=["']{kind}["']"""))


def meta_refresh(html: Column | str) -> Column:
    return col(html).rlike(r"""(?i)<meta[^>]+http-equiv=["']refresh["']""")


def action_texts(html: Column | str, most: int = MOST_ACTION_TEXTS) -> Column:
    """Texts of links, buttons and labelled inputs in document order."""
    whole = F.regexp_extract_all(col(html), F.lit(_ACTION), F.lit(0))
    texts = F.transform(whole, lambda m: collapse(F.concat(F.regexp_extract(m, _ACTION, 1), F.regexp_extract(m, _ACTION, 2))))
    return F.slice(F.filter(texts, lambda t: t != ""), 1, most)


def action_word_hits(texts: Column) -> Column:
    return F.filter(F.array(*map(F.lit, ACTION_WORDS)), lambda w: F.exists(texts, lambda t: F.contains(F.lower(t), w)))


def external_links(html: Column | str, base_host: Column) -> Column:
    """Links to another host than the page's; all links with a host if the page's is unknown."""
    links = F.regexp_extract_all(col(html), F.lit(r"""(?i)href=["']([^"']+)["']"""), F.lit(1))
    return F.size(F.filter(links, lambda u: host_of(u).isNotNull() & (base_host.isNull() | (host_of(u) != F.lower(base_host)))))


def with_html(df: DataFrame, html: str, base_host: Column) -> DataFrame:
    """``df`` with visible_text, html_features (null without HTML) and html_warnings."""
    df = df.withColumns({"visible_text": visible_text(html), "__title": title(html), "__texts": action_texts(html)})
    h = F.col(html)
    features = F.struct(
        F.lit("regex").alias("parser"),
        F.length(h).alias("html_length"),
        F.col("__title").alias("title"),
        F.coalesce(F.length("__title"), F.lit(0)).alias("title_length"),
        document_language(h).alias("document_language"),
        tag_count(h, "form").alias("form_count"),
        input_count(h, "password").alias("password_input_count"),
        input_count(h, "hidden").alias("hidden_input_count"),
        tag_count(h, "iframe").alias("iframe_count"),
        tag_count(h, "script").alias("script_count"),
        external_links(h, base_host).alias("external_link_count"),
        (input_count(h, "password") > 0).alias("has_password_input"),
        meta_refresh(h).alias("meta_refresh_present"),
        F.col("__texts").alias("action_texts"),
        action_word_hits(F.col("__texts")).alias("action_word_hits"),
        F.coalesce(F.length("visible_text"), F.lit(0)).alias("visible_text_length"),
    )
    warnings = F.array(F.when(filled(html), F.lit("fast_html_extraction")).otherwise("missing_html"))
    return df.withColumns({"visible_text": F.when(filled(html), F.col("visible_text")), "html_features": F.when(filled(html), features), "html_warnings": warnings}).drop("__title", "__texts")


def dom_visible_text(html: Column | str) -> Column:
    """Text of the body without scripts, styles and the like, by a real HTML parser, in Arrow batches."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def parsed(pages: pd.Series) -> pd.Series:
        from html.parser import HTMLParser

        hidden = {"script", "style", "noscript", "template", "svg", "canvas", "head"}

        class Reader(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.depth, self.found = 0, []

            def handle_starttag(self, tag, attrs):
                self.depth += tag in hidden

            def handle_endtag(self, tag):
                self.depth -= tag in hidden and self.depth > 0

            def handle_data(self, data):
                if not self.depth:
                    self.found.append(data)

        def text(page):
            if not page:
                return None
            reader = Reader()
            reader.feed(page)
            reader.close()
            return " ".join(" ".join(reader.found).split()) or None

        return pages.map(text)

    return parsed(col(html))
