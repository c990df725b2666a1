"""Ingest scalars: null-likes, labels, URLs and timestamps in free text, content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as missing, and the default label vocabularies.
NULL_LIKE = ("", "na", "n/a", "nan", "none", "null")
PHISHING_LABELS = ("phish", "phishing", "malicious", "fraud", "fraudulent", "bad")
BENIGN_LABELS = ("benign", "legitimate", "legit", "safe", "good", "ham")

# Column names tried for each role, the first existing one wins.
CANDIDATES = {
    "url": ("url", "uri", "link", "source_url", "landing_url", "page_url", "phish_url", "website", "domain"),
    "html": ("html", "raw_html", "page_html", "source_html", "content_html", "dom"),
    "text": ("text", "visible_text", "content", "body", "page_text", "document", "message"),
    "label": ("label", "class", "result", "category", "status"),
    "id": ("id", "sample_id", "row_id", "sha256", "uuid", "phish_id"),
    "split": ("split", "fold", "partition", "subset"),
    "timestamp": ("timestamp", "date", "created_at", "submission_time", "verification_time", "first_seen", "last_seen", "ingested_at", "crawl_time"),
    "language": ("language", "lang", "page_language"),
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str) -> Column:
    """Neither null nor empty."""
    return F.coalesce(col(c) != "", F.lit(False))


#: Unicode's white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def squeeze(c: Column | str) -> Column:
    """Trim all white space, Unicode included."""
    return F.btrim(col(c).cast("string"), F.lit(WHITE))


def is_null_like(c: Column | str) -> Column:
    s = col(c).cast("string")
    return s.isNull() | F.lower(squeeze(s)).isin(*NULL_LIKE)


def clean_text(c: Column | str) -> Column:
    return F.when(~is_null_like(c), squeeze(col(c).cast("string")))


def looks_like_html(c: Column | str) -> Column:
    return F.lower(col(c)).rlike("<(html|body|head|form|script|div)")


def pick_first(columns: Sequence[str], candidates: Sequence[str]) -> Column:
    """The first candidate that exists as a column, whatever its values; null if none does."""
    by_name = {c.lower(): c for c in reversed(list(columns))}
    found = next((by_name[c] for c in candidates if c in by_name), None)
    return F.lit(None).cast("string") if found is None else F.col(f"`{found}`")


def rest_as_map(columns: Sequence[str], without: Sequence[str]) -> Column:
    """All other columns as a map of cleaned strings, null-likes left out."""
    skip = {c.lower() for c in without}
    pairs = [x for c in columns if c.lower() not in skip for x in (F.lit(c), clean_text(F.col(f"`{c}`")))]
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def binary_label(c: Column | str, phishing: Sequence[str] = PHISHING_LABELS, benign: Sequence[str] = BENIGN_LABELS) -> Column:
    """1, 0 or null; the phishing vocabulary wins. Whole numbers are looked up without their decimals."""
    key = F.lower(squeeze(F.regexp_replace(col(c).cast("string"), r"^(-?[01])\.0$", "$1")))
    return F.when(key.isin(*phishing), 1).when(key.isin(*benign), 0)


def split_from_path(c: Column | str) -> Column:
    name = F.lower(F.element_at(F.split(col(c), "/"), -1))
    return F.when(name.contains("train"), "train").when(name.rlike("valid|dev|val"), "validation").when(name.contains("test"), "test")


def label_from_path(c: Column | str) -> Column:
    parts = F.split(F.lower(col(c)), "/")
    hit = lambda *w: F.arrays_overlap(parts, F.array(*map(F.lit, w)))
    return F.when(hit("phish", "phishing", "malicious"), "phishing").when(hit("benign", "legitimate", "legit", "safe"), "benign").when(hit("suspicious"), "suspicious")


def first_url(c: Column | str) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(col(c), r"(?i)https?://\S+", 0), "[,;]+$", ""), F.lit(""))


def timestamp_text(c: Column | str) -> Column:
    return F.when(col(c).rlike(r"[0-9]{4}-[0-9]{2}-[0-9]{2}"), squeeze(c))


def content_hash(c: Column | str) -> Column:
    """sha256, null for null and empty."""
    return F.when(filled(c), F.sha2(col(c), 256))


def sample_id(source: Column, original_id: Column, url: Column, html: Column, text: Column) -> Column:
    parts = [squeeze(source), squeeze(original_id), squeeze(url), content_hash(html), content_hash(text)]
    return F.sha2(F.concat_ws("||", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def modalities(url: Column, html: Column, text: Column, tabular: Column) -> Column:
    named = (("url", filled(url)), ("html", filled(html)), ("text", filled(text)), ("tabular", F.coalesce(F.size(tabular) > 0, F.lit(False))))
    return F.array_compact(F.array(*[F.when(on, F.lit(n)) for n, on in named]))


def hash_hex(c: Column, prefix: str = "") -> Column:
    """First 8 bytes of sha256 as 16 hex digits, which sort like the unsigned number they are."""
    return F.substring(F.sha2(F.concat(F.lit(prefix), c.cast("string")), 256), 1, 16)


def hash_fraction(c: Column, prefix: str = "") -> Column:
    """The same as a fraction of 2^64 - 1."""
    return F.conv(hash_hex(c, prefix), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551615.0)
