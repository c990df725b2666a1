"""URL parsing, normalisation and features as one struct expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalars import col, squeeze
from lakemill.functions.suffixes import COMMON, SuffixRules

# Keywords that make a URL suspicious.
KEYWORDS = ("login", "verify", "update", "secure", "account", "signin", "confirm", "password", "wallet", "bank", "auth")

# The features that URL models learn from.
MODEL_FEATURES = (
    "is_ip_address", "has_punycode", "has_percent_encoding", "url_length", "path_length", "query_length", "num_subdomains", "suspicious_keyword_count",
    "digit_count", "digit_ratio", "hostname_digit_count", "contains_at_symbol", "contains_double_slash_path", "contains_hyphenated_hostname", "path_depth", "query_param_count",
)

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_IPV4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}(?<!\.)$"
_IPV6 = r"^(?=.*:)(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}|(?=(?:[0-9a-f]{0,4}:){0,7}[0-9a-f]{0,4}$)(?:(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*)?::(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*)?))$"


def _null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def digits(c: Column) -> Column:
    """Characters that are decimal digits or superscripts, as far as Latin text has them."""
    return F.regexp_count(c, F.lit(r"(?U)[\p{Nd}²³¹]"))


def is_ip(host: Column) -> Column:
    return host.rlike(_IPV4) | host.rlike(_IPV6)


def keyword_hits(c: Column, keywords: Sequence[str] = KEYWORDS) -> Column:
    """Sorted distinct keywords that occur, whatever their case."""
    low = F.lower(c)
    return F.array_compact(F.array(*[F.when(low.contains(k), F.lit(k)) for k in sorted(set(keywords))])) if keywords else F.array().cast("array<string>")


def with_url(df: DataFrame, source: str, prefix: str = "", keywords: Sequence[str] = KEYWORDS, rules: SuffixRules = COMMON) -> DataFrame:
    """``df`` with columns original_url, normalized_url, url_features and url_warnings; ``rules`` say what a public suffix is.

    Works in narrow projections, so that each piece is computed once. A text without a scheme and ``//`` is
    taken as an authority. Never fails: what cannot be parsed leaves nulls and a warning.
    """
    base = _null_if_empty(squeeze(source))
    bare = (F.regexp_extract(F.col("__u"), _PARTS, 2) == "") & ~F.col("__u").contains("://")
    df = df.withColumn("__u", base).withColumn("__assumed", bare)
    df = df.withColumn("__e", F.when(F.col("__assumed"), F.concat(F.lit("//"), F.col("__u"))).otherwise(F.col("__u")))
    names = ("__scheme", "__auth", "__path", "__query", "__frag")
    df = df.withColumns({n: F.regexp_extract("__e", _PARTS, k + 1) for k, n in enumerate(names)})
    hostname = _null_if_empty(F.lower(F.regexp_replace(F.regexp_extract("__auth", r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1), r"[\[\]]", "")))
    port_text = F.regexp_extract("__auth", r"^(?:.*@)?(?:\[[^\]]*\]|[^:]*):?(.*)$", 1)
    df = df.withColumns({"__host": hostname, "__port_text": port_text, "__scheme": F.lower("__scheme")})
    number = F.when(F.col("__port_text").rlike("^[0-9]{1,9}$"), F.col("__port_text").try_cast("int"))
    df = df.withColumn("__port", F.when(number.between(0, 65535), number))
    labels = F.filter(F.split("__host", r"\."), lambda x: x != "")
    df = df.withColumns({"__ip": F.coalesce(is_ip(F.col("__host")), F.lit(False)), "__labels": labels})
    df = df.withColumn("__known", rules.labels_of_suffix("__labels"))
    n, known = F.size("__labels"), F.col("__known")
    several = (n >= 2) & ~F.col("__ip")
    whole = several & (n <= known)  # the host is a suffix itself
    u, host, path, query = (F.col(c) for c in ("__u", "__host", "__path", "__query"))
    found = host.isNotNull()
    df = df.withColumns(
        {
            "__domain": F.when(several & ~whole, F.concat_ws(".", F.slice("__labels", F.greatest(n - known, F.lit(1)), known + 1))).when(several, F.concat_ws(".", "__labels")).otherwise(host),
            "__sub": F.when(several & (n > known + 1), F.concat_ws(".", F.slice("__labels", 1, F.greatest(n - known - 1, F.lit(0))))),
            "__suffix": F.when(several, F.concat_ws(".", F.slice("__labels", F.greatest(n - known + 1, F.lit(1)), known))),
            "__hits": keyword_hits(u, keywords),
            "__digits": digits(u),
        }
    )
    features = F.struct(
        _null_if_empty(F.col("__scheme")).alias("scheme"),
        host.alias("hostname"),
        F.col("__domain").alias("registered_domain"),
        F.col("__sub").alias("subdomain"),
        F.col("__suffix").alias("suffix"),
        F.col("__port").alias("port"),
        F.col("__ip").alias("is_ip_address"),
        F.coalesce(host.contains("xn--"), F.lit(False)).alias("has_punycode"),
        F.when(found, u.rlike("%[0-9a-fA-F]{2}")).otherwise(u.contains("%")).alias("has_percent_encoding"),
        F.length(u).alias("url_length"),
        F.length(path).alias("path_length"),
        F.length(query).alias("query_length"),
        F.when(F.col("__sub").isNull(), 0).otherwise(n - known - 1).alias("num_subdomains"),
        F.when(found, F.size(F.filter(F.split(path, "/"), lambda x: x != ""))).alias("path_depth"),
        F.when(found, F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1)).alias("query_param_count"),
        F.col("__hits").alias("suspicious_keyword_hits"),
        F.when(found, F.size("__hits")).alias("suspicious_keyword_count"),
        F.col("__digits").alias("digit_count"),
        F.bround(F.col("__digits") / F.length(u), 6).alias("digit_ratio"),
        F.when(found, digits(host)).alias("hostname_digit_count"),
        F.when(found, u.contains("@")).alias("contains_at_symbol"),
        F.when(found, path.contains("//")).alias("contains_double_slash_path"),
        F.when(found, host.contains("-")).alias("contains_hyphenated_hostname"),
    )
    user = F.regexp_extract("__auth", "^(.*@)?", 1)
    normalized = F.concat(
        F.when(F.col("__scheme") != "", F.concat(F.col("__scheme"), F.lit(":"))).otherwise(""),
        F.lit("//"), user, host,
        F.when(F.col("__port").isNotNull(), F.concat(F.lit(":"), F.col("__port"))).otherwise(""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(F.col("__frag") != "", F.concat(F.lit("#"), F.col("__frag"))).otherwise(""),
    )
    warnings = F.array_compact(
        F.array(
            F.when(u.isNull(), F.lit("missing_url")),
            F.when(F.col("__assumed"), F.lit("scheme_missing_assumed_network_location")),
            F.when((F.col("__port_text") != "") & F.col("__port").isNull(), F.lit("invalid_port")),
            F.when(u.isNotNull() & host.isNull(), F.lit("hostname_missing")),
        )
    )
    df = df.withColumns(
        {
            f"{prefix}original_url": u,
            f"{prefix}normalized_url": F.when(found, normalized).otherwise(u),
            f"{prefix}url_features": F.when(u.isNotNull(), features),
            f"{prefix}url_warnings": warnings,
        }
    )
    return df.drop("__u", "__assumed", "__e", *names, "__host", "__port_text", "__port", "__ip", "__labels", "__known", "__domain", "__sub", "__suffix", "__hits", "__digits")


def model_features(features: str | Column = "url_features") -> Column:
    """The features that URL models learn from, as a struct; null without a URL."""
    features = F.col(features) if isinstance(features, str) else features
    return F.when(features.isNotNull(), F.struct(*[features[n].alias(n) for n in MODEL_FEATURES]))


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute or ``//`` URL, else null."""
    return _null_if_empty(F.lower(F.regexp_extract(col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)", 1)))


def with_public_suffix(df: DataFrame, host: str, suffixes: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """``df`` with ``public_suffix``: the longest listed suffix of each host.

    ``suffixes`` has one column ``suffix``. It is broadcast up to ``most_rows`` rows and joined by shuffle beyond.
    """
    listed = suffixes.select(F.col("suffix").alias("__s")).distinct()
    side = F.broadcast(listed) if suffixes.limit(most_rows + 1).count() <= most_rows else listed
    hosts = df.select(host).distinct().where(F.col(host).isNotNull())
    parts = F.split(host, r"\.")
    tails = hosts.withColumn("__s", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat_ws(".", F.slice(parts, k, F.size(parts))))))
    best = tails.join(side, "__s").groupBy(host).agg(F.max_by("__s", F.length("__s")).alias("public_suffix"))
    return df.join(best, host, "left")
