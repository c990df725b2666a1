"""Text normalisation and features, languages, labels, record checks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.html import collapse
from lakemill.functions.scalars import binary_label, col, content_hash, filled, squeeze

# Terms of urgency, and names of languages.
URGENCY_TERMS = ("urgent", "verify", "confirm", "suspend", "login", "password", "reset", "security")
LANGUAGE_ALIASES = {"ara": "ar", "arabic": "ar", "eng": "en", "english": "en", "fra": "fr", "fre": "fr", "french": "fr"}
NO_LANGUAGE = ("", "none", "null", "nan", "unknown", "und")

#: Texts that are Python strings at once.
ROWS = 256

URL = r"(?i)https?://\S+"
#: As a regular expression without Unicode's classes has it; the long s is a lower-case form of S.
PLAIN_URL = r"[Hh][Tt][Tt][Pp][Ss\u017f]?://[^\t\n\f\r ]+"
#: Unicode's space separators.
SPACES = " \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
EMAIL = r"(?U)\b[\w.\-+%]+@[\w.\-]+\.\w+\b"


def _normalized(texts: pa.Array) -> pa.Array:
    """In slices, as Python's strings take up to four bytes a character; a batch of Arrow may be large."""
    import unicodedata

    parts = [pa.array([t if t is None else unicodedata.normalize("NFKC", t) for t in texts.slice(i, ROWS).to_pylist()], texts.type) for i in range(0, len(texts), ROWS)]
    return pa.concat_arrays(parts) if parts else texts


def nfkc(c: Column) -> Column:
    """Unicode NFKC; only texts beyond ASCII leave the JVM, in Arrow batches."""
    normalized = F.arrow_udf(_normalized, "string")

    wide = F.when(c.rlike(r"[^\x00-\x7F]"), c)
    return F.coalesce(normalized(wide), c)


def normalize_text(c: Column | str, lower: bool = False, unicode: bool = True) -> Column:
    out = squeeze(c)
    out = nfkc(out) if unicode else out
    out = collapse(F.regexp_replace(out, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " "))
    return F.nullif(F.lower(out) if lower else out, F.lit(""))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def word_grams(t: Column, sizes: tuple[int, ...] = (1, 2)) -> Column:
    """N-grams of an array column; pass a column, not an expression, which would be computed per n-gram."""

    def of(n: int) -> Column:
        if n == 1:
            made = F.transform(t, lambda w: F.concat_ws(" ", w))
        elif n == 2:  # neighbours, without an array for each pair
            made = F.zip_with(F.slice(t, 1, F.size(t) - 1), F.slice(t, 2, F.size(t) - 1), lambda a, b: F.concat_ws(" ", a, b))
        else:
            made = F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - (n - 1), F.lit(1))), lambda i: F.concat_ws(" ", F.slice(t, i, n)))
        return F.when(F.size(t) >= n, made).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*[of(n) for n in sizes]))


def urgency_terms(c: Column, lower=F.lower) -> Column:
    low = lower(c)
    return F.array_compact(F.array(*[F.when(low.contains(t), F.lit(t)) for t in URGENCY_TERMS]))


def text_features(original: Column, normalized: Column) -> Column:
    """Null without text."""
    trimmed = squeeze(original)
    made = F.struct(
        F.length(trimmed).alias("original_length"),
        F.coalesce(F.length(normalized), F.lit(0)).alias("normalized_length"),
        F.coalesce(F.size(tokens(normalized)), F.lit(0)).alias("token_count"),
        F.regexp_count(trimmed, F.lit(URL)).alias("url_count"),
        F.when(trimmed.contains("@"), F.regexp_count(trimmed, F.lit(EMAIL))).otherwise(0).alias("email_count"),
        urgency_terms(normalized).alias("urgency_terms"),
    )
    return F.when(filled(trimmed), made)


def plain_text_features(c: Column) -> Column:
    """The same of a text as it stands: every at sign counts, white space is ASCII's, and of Unicode only case and the spaces at the ends."""
    return F.struct(
        F.length(F.btrim(c, F.lit(SPACES))).alias("original_length"),
        F.regexp_count(c, F.lit(r"[^\t\n\f\r ]+")).alias("token_count"),
        F.regexp_count(c, F.lit(PLAIN_URL)).alias("url_count"),
        (F.length(c) - F.length(F.replace(c, F.lit("@"), F.lit("")))).alias("email_count"),
        urgency_terms(c, lambda x: F.lower(F.replace(x, F.lit("\u0130"), F.lit("i")))).alias("urgency_terms"),
    )


def prefix_hash(normalized: Column, most: int = 512) -> Column:
    return content_hash(F.substring(normalized, 1, most))


def canonical_language(c: Column | str) -> Column:
    low = F.lower(squeeze(F.coalesce(col(c), F.lit(""))))
    aliases = F.create_map(*[F.lit(x) for kv in LANGUAGE_ALIASES.items() for x in kv])
    dashed = F.replace(low, F.lit("_"), F.lit("-"))
    first = F.coalesce(F.try_element_at(aliases, dashed), dashed)
    main = F.split_part(first, F.lit("-"), F.lit(1))
    return F.when(low.isin(*NO_LANGUAGE), "unknown").otherwise(F.coalesce(F.try_element_at(aliases, main), main))


def script_language(text: Column) -> Column:
    return F.when(F.regexp_count(text, F.lit("[؀-ۿ]")) >= 8, "ar")


def resolve_language(given: Column, document: Column, text: Column) -> Column:
    known = lambda c: F.nullif(canonical_language(c), F.lit("unknown"))
    return F.coalesce(known(given), known(document), script_language(text), F.lit("unknown"))


# The labels understood when a source supplies none of its own.
FALLBACK_PHISHING = ("phish", "phishing", "malicious", "fraudulent", "-1")
FALLBACK_BENIGN = ("benign", "legitimate", "legit", "safe", "1")


def record_label(source: Column, label: Column, given: Column) -> Column:
    """Struct (normalized_label, label_name, mapping_reason, is_auxiliary, is_supervised) by source rules."""

    def made(value, name, reason, auxiliary=False):
        value = value if isinstance(value, Column) else F.lit(value).cast("int")
        return F.struct(value.alias("normalized_label"), (name if isinstance(name, Column) else F.lit(name)).alias("label_name"), F.lit(reason).alias("mapping_reason"), F.lit(auxiliary).alias("is_auxiliary"), value.isNotNull().alias("is_supervised"))

    fallback = binary_label(label, FALLBACK_PHISHING, FALLBACK_BENIGN)
    named = lambda v: F.when(v == 1, "phishing").otherwise("benign")
    return (
        F.when(source == "oscar_aux", made(None, "auxiliary_unlabeled", "auxiliary_text_corpus", True))
        .when(source == "openphish", made(1, "phishing", "phishing_only_feed"))
        .when((source == "phishtank") & (given == 1), made(1, "phishing", "confirmed_phishtank_entry"))
        .when(source == "phishtank", made(None, "unknown", "unconfirmed_or_missing_verification"))
        .when(given.isin(0, 1), made(given.cast("int"), named(given), "adapter_supplied_binary_label"))
        .when(fallback.isNotNull(), made(fallback, named(fallback), "central_fallback_mapping"))
        .otherwise(made(None, "unknown", "unmapped_or_unlabeled"))
    )


def label_bucket(label: Column) -> Column:
    return F.when(label == 1, "phishing").when(label == 0, "benign").otherwise("null")


def validation_warnings(df_columns: dict[str, Column]) -> Column:
    """Codes of what is wrong with a record, given its columns by role."""
    c = df_columns
    flags = c["modality_flags"]
    names = ("has_original_url", "has_normalized_url", "has_raw_html", "has_extracted_text", "has_normalized_text", "has_tabular_features", "is_auxiliary")
    any_flag = F.coalesce(F.greatest(*[flags[n] for n in names]), F.lit(False))
    rules = (
        ("missing_sample_id", ~filled(c["sample_id"])),
        ("missing_source_dataset", ~filled(c["source_dataset"])),
        ("invalid_normalized_label", c["normalized_label"].isNotNull() & ~c["normalized_label"].isin(0, 1)),
        ("auxiliary_record_should_not_have_binary_label", c["is_auxiliary"] & c["normalized_label"].isNotNull()),
        ("tabular_record_contains_webpage_fields", flags["has_tabular_features"] & (filled(c["extracted_text"]) | filled(c["raw_html"]))),
        ("record_has_no_modalities", ~any_flag),
        ("normalized_url_without_hostname", flags["has_normalized_url"] & ~filled(c["hostname"])),
    )
    return F.array_compact(F.array(*[F.when(F.coalesce(on, F.lit(False)), F.lit(n)) for n, on in rules]))


VIEWS = ("unified_url_dataset", "unified_webpage_dataset", "unified_tabular_dataset", "unified_auxiliary_text_dataset")


def views(flags: Column, is_auxiliary: Column) -> Column:
    """Views a record belongs to; it may be several."""
    text = flags["has_extracted_text"] | flags["has_normalized_text"]
    on = (flags["has_normalized_url"], ~is_auxiliary & (flags["has_raw_html"] | text), flags["has_tabular_features"], is_auxiliary & text)
    return F.array_compact(F.array(*[F.when(o, F.lit(v)) for v, o in zip(VIEWS, on)]))


def supervised_only(df: DataFrame, label: str, present: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with label 0 or 1 and the needed content, and a one-row table of what was left out."""
    labelled = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    has = F.coalesce(present, F.lit(False))
    counts = df.agg(F.count_if(~labelled).alias("unlabeled"), F.count_if(labelled & ~has).alias("missing_content"), F.count_if(labelled & has).alias("kept"))
    return df.where(labelled & has), counts
