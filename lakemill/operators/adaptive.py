"""Error analysis, drift, retraining candidates and proposals of heuristics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.scalars import sample_id
from lakemill.functions.text import word_grams

PROPOSAL_TOKEN = r"(?U)\b[\w\-]{4,}\b"


def latest(df: DataFrame, key: str, seq: Column | str) -> DataFrame:
    """One row per key, the last by ``seq``; rows without a key go."""
    order = F.col(seq) if isinstance(seq, str) else seq
    rows = df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns if c != key]), order).alias("__row")).select(key, "__row.*")


# --- errors --------------------------------------------------------------------------------------


#: Action texts that an error shows.
MOST_ACTIONS = 10

#: Roll-ups of an error report, and the columns that may hold them.
ROLLUPS = {"language": ("language",), "source": ("source_dataset", "source"), "domain": ("registered_domain",), "tld": ("suffix", "tld")}


def error_rollups(wrong: DataFrame) -> DataFrame:
    """(dim, value, false_positives, false_negatives) by language, source, domain and top-level domain, in one shuffle; what is missing is ``unknown``."""
    pairs = []
    for dim, columns in ROLLUPS.items():
        own = next((F.col(c) for c in columns if c in wrong.columns), F.lit(None).cast("string"))
        pairs.append(F.struct(F.lit(dim).alias("dim"), F.coalesce(F.nullif(own, F.lit("")), F.lit("unknown")).alias("value")))
    rows = wrong.select("error_type", F.inline(F.array(*pairs)))
    return rows.groupBy("dim", "value").agg(F.count_if(F.col("error_type") == "false_positive").alias("false_positives"), F.count_if(F.col("error_type") == "false_negative").alias("false_negatives"))


def errors(predictions: DataFrame, processed: DataFrame, seq: str = "seq") -> DataFrame:
    """False positives and negatives with their record's language, domain, snippet and action texts."""
    wrong = predictions.where(((F.col("label") == 0) & (F.col("predicted") == 1)) | ((F.col("label") == 1) & (F.col("predicted") == 0)))
    wrong = wrong.withColumn("error_type", F.when(F.col("label") == 1, "false_negative").otherwise("false_positive"))
    if "action_texts" in processed.columns:
        processed = processed.withColumn("action_texts", F.slice("action_texts", 1, MOST_ACTIONS))
    side = latest(processed, "sample_id", seq)
    return wrong.join(side, "sample_id", "left").withColumn("text_snippet", F.substring("normalized_text", 1, 240)).drop("normalized_text", seq)


def count_by(df: DataFrame, dim: str, *more: str) -> DataFrame:
    return df.groupBy(*more, F.coalesce(F.col(dim), F.lit("unknown")).alias(dim)).agg(F.count(F.lit(1)).alias("n"))


def long_tokens(text: Column, least: int = 4, most: int | None = None) -> Column:
    found = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda t: F.length(t) >= least)
    return found if most is None else F.slice(found, 1, most)


def top_tokens(df: DataFrame, text: str, k: int = 10, least: int = 4, most: int | None = None) -> DataFrame:
    rows = df.select(F.explode(long_tokens(F.col(text), least, most)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return rows.orderBy(F.desc("n"), "token").limit(k)


def opportunities(wrong: DataFrame, k: int = 10) -> DataFrame:
    """(kind, value, n): action texts and domains of missed phishing, and a guardrail if anything was flagged falsely."""
    missed = wrong.where("error_type = 'false_negative'")
    cta = missed.select(F.explode("action_texts").alias("t")).select(F.lower("t").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(max(1, k // 2))
    dom = missed.where("registered_domain is not null").groupBy(F.col("registered_domain").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(max(1, k // 2))
    guard = wrong.where("error_type = 'false_positive'").agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit("review_false_positives").alias("value"), "n")
    rows = cta.select(F.lit("cta").alias("kind"), "value", "n").union(dom.select(F.lit("domain").alias("kind"), "value", "n")).union(guard.select(F.lit("guardrail").alias("kind"), "value", "n"))
    return rows.limit(k)


# --- drift ---------------------------------------------------------------------------------------


def sides(reference: DataFrame, current: DataFrame) -> DataFrame:
    return reference.withColumn("side", F.lit("reference")).unionByName(current.withColumn("side", F.lit("current")))


def distributions(both: DataFrame, dims: list[str]) -> DataFrame:
    """(dim, value, reference, current) for all dimensions in one shuffle; null counts as 'None'."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.coalesce(F.col(d).cast("string"), F.lit("None")).alias("value")) for d in dims])
    rows = both.select("side", F.explode(pairs).alias("x")).select("side", "x.*")
    return rows.groupBy("dim", "value").agg(F.count_if(F.col("side") == "reference").alias("reference"), F.count_if(F.col("side") == "current").alias("current"))


def divergence(hist: DataFrame, by: str = "dim") -> DataFrame:
    """Jensen-Shannon divergence in bits; an empty side is a distribution of zeros."""
    total = hist.groupBy(by).agg(F.sum("reference").alias("r"), F.sum("current").alias("c"))
    rows = hist.join(total, by)
    p, q = F.col("reference") / F.greatest(F.col("r"), F.lit(1)), F.col("current") / F.greatest(F.col("c"), F.lit(1))
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return rows.groupBy(by).agg(F.sum((part(p) + part(q)) / 2).alias("js_divergence"))


def score_shift(both: DataFrame, score: str = "score") -> DataFrame:
    stat = lambda side: (F.avg(F.when(F.col("side") == side, F.col(score))), F.coalesce(F.stddev_pop(F.when(F.col("side") == side, F.col(score))), F.lit(0.0)))
    (rm, rs), (cm, cs) = stat("reference"), stat("current")
    out = both.agg(rm.alias("reference_mean"), rs.alias("reference_std"), cm.alias("current_mean"), cs.alias("current_std"))
    return out.withColumns({"mean_shift": F.col("current_mean") - F.col("reference_mean"), "available": F.col("current_mean").isNotNull() & F.col("reference_mean").isNotNull()})


def token_shift(both: DataFrame, text: str, k: int = 25) -> DataFrame:
    rows = both.select("side", F.explode(long_tokens(F.col(text), 4, 200)).alias("token"))
    counts = rows.groupBy("token").agg(F.count_if(F.col("side") == "reference").alias("reference"), F.count_if(F.col("side") == "current").alias("current"))
    return counts.withColumn("delta", F.col("current") - F.col("reference")).orderBy(F.abs("delta").desc(), "token").limit(k)


DRIFT_DIMENSIONS = ("label", "language", "source", "tld")


def _field(df: DataFrame, *names: str) -> Column:
    """The first column there is, as text; ``a.b`` is a field of a struct or of a JSON text."""
    for name in names:
        column, _, inner = name.partition(".")
        if column in df.columns:
            if not inner:
                return F.col(column).cast("string")
            kind = dict(df.dtypes)[column]
            return F.get_json_object(column, f"$.{inner}") if kind == "string" else F.col(column)[inner].cast("string") if f"{inner}:" in kind else F.lit(None).cast("string")
    return F.lit(None).cast("string")


def drift_rows(df: DataFrame) -> DataFrame:
    """(label, language, source, tld, score, text) of records or predictions of any kind; a missing label is ``None``, other values ``unknown``."""
    known = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))
    text = F.coalesce(F.nullif(_field(df, "normalized_text"), F.lit("")), _field(df, "extracted_text"))
    return df.select(
        F.coalesce(_field(df, "normalized_label", "label"), F.lit("None")).alias("label"), known(_field(df, "language")).alias("language"), known(_field(df, "source_dataset", "source")).alias("source"),
        known(_field(df, "url_features.suffix", "tld")).alias("tld"), _field(df, "score").try_cast("double").alias("score"), text.alias("text"),
    )


def drift_report(reference: DataFrame, current: DataFrame, k: int = 25) -> DataFrame:
    """One table of everything that may have shifted: (section, item, reference, current, measure).

    Section ``rows`` counts both sides; a distribution has a row for each value, its counts, and the Jensen-Shannon divergence in bits
    of the whole dimension; ``score`` has mean and standard deviation and their differences (no rows unless both
    sides have scores); ``token`` the ``k`` tokens whose counts differ most, and by how much.
    """
    both = sides(drift_rows(reference), drift_rows(current))
    number = lambda c: F.col(c).cast("double").alias(c)
    counts = both.agg(F.count_if(F.col("side") == "reference").alias("reference"), F.count_if(F.col("side") == "current").alias("current"))
    counts = counts.select(F.lit("rows").alias("section"), F.lit("count").alias("item"), number("reference"), number("current"), (F.col("current") - F.col("reference")).cast("double").alias("measure"))
    values = distributions(both, list(DRIFT_DIMENSIONS))
    values = values.join(divergence(values), "dim").select(F.col("dim").alias("section"), F.col("value").alias("item"), number("reference"), number("current"), F.col("js_divergence").alias("measure"))
    shift = score_shift(both).where("available")
    score = shift.select(F.inline(F.array(*[F.struct(F.lit("score").alias("section"), F.lit(x).alias("item"), F.col(f"reference_{x}").alias("reference"), F.col(f"current_{x}").alias("current"), (F.col(f"current_{x}") - F.col(f"reference_{x}")).alias("measure")) for x in ("mean", "std")])))
    tokens = token_shift(both, "text", k).select(F.lit("token").alias("section"), F.col("token").alias("item"), number("reference"), number("current"), F.col("delta").cast("double").alias("measure"))
    return counts.union(values).union(score).union(tokens)


def drift_document(report: DataFrame) -> dict:
    """A report as one nested document, to be written as JSON; as large as the dimensions' values."""
    out: dict = {f"{d}_distribution": {"reference": {}, "current": {}, "js_divergence": 0.0} for d in DRIFT_DIMENSIONS} | {"score_distribution": {"available": False}, "top_token_shift": []}
    for r in report.collect():
        if r["section"] == "rows":
            out |= {"reference_count": int(r["reference"]), "current_count": int(r["current"])}
        elif r["section"] == "score":
            out["score_distribution"] |= {"available": True, f"reference_{r['item']}": r["reference"], f"current_{r['item']}": r["current"]}
        elif r["section"] == "token":
            out["top_token_shift"].append({"token": r["item"], "reference_count": int(r["reference"]), "current_count": int(r["current"]), "delta": int(r["measure"])})
        else:
            at = out[f"{r['section']}_distribution"]
            at["js_divergence"] = r["measure"]
            for side in ("reference", "current"):
                if r[side]:
                    at[side][r["item"]] = int(r[side])
    return out


# --- retraining and proposals --------------------------------------------------------------------


def with_feedback(df: DataFrame, feedback: DataFrame, seq: str = "seq") -> DataFrame:
    side = latest(feedback.select("sample_id", "final_reviewed_label", seq), "sample_id", seq).drop(seq)
    return df.join(side, "sample_id", "left")


def retraining_candidates(predictions: DataFrame, feedback: DataFrame, low: float = 0.4, high: float = 0.6) -> DataFrame:
    rows = with_feedback(predictions, feedback)
    reviewed = F.col("final_reviewed_label")
    reasons = F.array_compact(
        F.array(
            F.when(reviewed.isNotNull() & (reviewed != F.col("predicted")), F.lit("misclassified_after_review")),
            F.when(reviewed.isNotNull(), F.lit("reviewed_label_available")),
            F.when(F.col("score").between(low, high), F.lit("uncertain_score")),
        )
    )
    return rows.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def retraining_summary(candidates: DataFrame) -> DataFrame:
    has = lambda r: F.count_if(F.array_contains("reasons", r))
    return candidates.agg(F.count(F.lit(1)).alias("candidates"), has("uncertain_score").alias("uncertain"), has("reviewed_label_available").alias("reviewed"), has("misclassified_after_review").alias("misclassified"))


def truth(df: DataFrame) -> Column:
    """The reviewed label if there is one, else the stored one."""
    if "final_reviewed_label" in df.columns:
        return F.when(F.col("final_reviewed_label").isin(0, 1), F.col("final_reviewed_label")).otherwise(F.col("label"))
    return F.col("label")


def pattern_words(text: Column, most: int = 80) -> Column:
    return F.slice(F.regexp_extract_all(F.lower(text), F.lit(PROPOSAL_TOKEN), F.lit(0)), 1, most)


def _counted(df: DataFrame, patterns: Column, kind: str) -> DataFrame:
    """Counts of each pattern among phishing and benign rows."""
    rows = df.select(truth(df).alias("y"), F.explode(patterns).alias("pattern")).where("y in (0, 1)")
    out = rows.groupBy("pattern").agg(F.count_if(F.col("y") == 1).alias("phishing"), F.count_if(F.col("y") == 0).alias("benign"))
    return out.withColumns({"kind": F.lit(kind), "precision_proxy": F.col("phishing") / F.greatest(F.lit(1), F.col("phishing") + F.col("benign")), "status": F.lit("proposed")})


#: Rows that a proposal shows.
EXAMPLES = 3


def with_evidence(chosen: DataFrame, df: DataFrame, patterns: Column, whole_languages: bool = False) -> DataFrame:
    """``chosen`` with ``source_support`` (occurrences by source), ``examples`` (the first EXAMPLES phishing rows by ``seq``) and ``languages``.

    ``chosen`` is as small as its generator's limit makes it, and is broadcast. Sources are counted with map-side sums, first rows
    are picked within partitions before they meet, and only the examples' rows are read for their texts. Languages
    are those of the examples, or of all phishing rows. Sources and languages that are missing count as ``unknown`` and as none.
    """
    for c in ("source_dataset", "normalized_url", "original_url", "normalized_text", "extracted_text", "sample_id"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    phishing = df.where(truth(df) == 1)
    source = F.coalesce(F.nullif("source_dataset", F.lit("")), F.lit("unknown"))
    found = phishing.select("seq", source.alias("source"), F.posexplode(patterns).alias("at", "pattern")).join(F.broadcast(chosen.select("pattern")), "pattern")
    by_source = found.groupBy("pattern", "source").agg(F.count(F.lit(1)).alias("n")).groupBy("pattern")
    support = by_source.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("source_support"))
    nth = F.row_number().over(Window.partitionBy("pattern").orderBy("seq", "at"))
    first = found.withColumn("nth", nth).where(F.col("nth") <= EXAMPLES).select("pattern", "nth", F.col("seq").alias("of"))
    shown = F.struct("sample_id", "source_dataset", "language", F.coalesce("normalized_url", "original_url").alias("url"), F.substring(F.coalesce("normalized_text", "extracted_text", F.lit("")), 1, 240).alias("text_snippet"))
    examples = phishing.select("seq", shown.alias("example")).join(F.broadcast(first), F.col("seq") == F.col("of"))
    examples = examples.groupBy("pattern").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "example"))), lambda x: x["example"]).alias("examples"))
    out = chosen.join(support, "pattern", "left").join(examples, "pattern", "left")
    if whole_languages:
        languages = F.array(*[F.lit(r[0]) for r in phishing.select("language").distinct().collect() if r[0]]).cast("array<string>")
    else:
        languages = F.filter(F.array_distinct(F.transform("examples", lambda e: e["language"])), lambda x: x.isNotNull() & (x != ""))
    return out.withColumn("languages", F.array_sort(F.coalesce(languages, F.array().cast("array<string>"))))


def _phrases(df: DataFrame) -> tuple[DataFrame, Column]:
    return df.withColumn("__words", pattern_words(F.col("normalized_text"))), word_grams(F.col("__words"), (1, 2, 3))


def _actions() -> Column:
    return F.filter(F.transform("action_texts", lambda t: F.lower(F.trim(t))), lambda t: t != "")


def _flagged(flags: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))


def phrase_proposals(df: DataFrame, k: int = 50, least: int = 3, floor: float = 0.7, evidence: bool = False) -> DataFrame:
    df, grams = _phrases(df)
    found = _counted(df, grams, "phrase").where(F.col("phishing") >= least).orderBy(F.desc("phishing"), "pattern").limit(3 * k).where(F.col("precision_proxy") >= floor)
    return with_evidence(found, df, F.array_distinct(grams)) if evidence else found


def cta_proposals(df: DataFrame, k: int = 50, least: int = 2, floor: float = 0.65, evidence: bool = False) -> DataFrame:
    found = _counted(df, _actions(), "cta").where(F.col("phishing") >= least).orderBy(F.desc("phishing"), "pattern").limit(2 * max(10, k // 2)).where(F.col("precision_proxy") >= floor)
    return with_evidence(found, df, _actions()) if evidence else found


def flag_proposals(df: DataFrame, flags: dict[str, Column], kind: str, least: int = 2, evidence: bool = False) -> DataFrame:
    """Proposals from boolean features, each a pattern of its own."""
    found = _counted(df, _flagged(flags), kind).where(F.col("phishing") >= least)
    return with_evidence(found, df, _flagged(flags), whole_languages=True) if evidence else found


def ranked(parts: list[DataFrame], k: int = 50) -> DataFrame:
    rows = reduce(DataFrame.unionByName, parts)
    return rows.orderBy(F.desc("phishing"), F.desc("precision_proxy"), "kind", "pattern").limit(k)


URL_FLAGS = ("is_ip_address", "has_punycode", "has_percent_encoding", "contains_at_symbol", "contains_double_slash_path")
HTML_FLAGS = ("meta_refresh_present", "has_password_input")


def url_proposals(df: DataFrame, evidence: bool = False) -> DataFrame:
    return flag_proposals(df, {n: F.col("url_features")[n] for n in URL_FLAGS}, "url_style", evidence=evidence)


def html_proposals(df: DataFrame, evidence: bool = False) -> DataFrame:
    return flag_proposals(df, {n: F.col("html_features")[n] for n in HTML_FLAGS}, "html_pattern", evidence=evidence)


def proposals(df: DataFrame, k: int = 25, evidence: bool = True) -> DataFrame:
    """The k first proposals of phrases, action texts, URL flags and HTML flags together; records of a view will do."""
    if "label" not in df.columns:
        df = df.withColumn("label", F.col("normalized_label"))
    if "action_texts" not in df.columns:
        df = df.withColumn("action_texts", F.coalesce(F.col("html_features.action_texts"), F.array().cast("array<string>")))
    return ranked([phrase_proposals(df, k, evidence=evidence), cta_proposals(df, k, evidence=evidence), url_proposals(df, evidence), html_proposals(df, evidence)], k)


# Names of the kinds in records of proposals.
RULE_TYPES = {"phrase": "text_phrase", "cta": "cta_pattern", "url_style": "url_obfuscation", "html_pattern": "html_pattern"}


def proposal_records(found: DataFrame, created_at: str) -> DataFrame:
    """Records of proposals with evidence, to be written as JSON lines; ``created_at`` is an ISO time and part of their ids."""
    rule = F.element_at(F.create_map(*[F.lit(x) for pair in RULE_TYPES.items() for x in pair]), F.col("kind"))
    none = F.lit(None).cast("string")
    seen = F.format_string("%d of %d labelled occurrences are in phishing rows, from %d sources.", F.col("phishing"), F.col("phishing") + F.col("benign"), F.size("source_support"))
    return found.select(
        sample_id(F.lit("heuristic_proposal"), F.concat_ws(":", rule, "pattern", F.lit(created_at)), none, none, none).alias("proposal_id"),
        rule.alias("rule_type"), F.col("pattern").alias("candidate_pattern"), seen.alias("rationale"), F.col("examples").alias("supporting_examples"), F.col("phishing").alias("supporting_count"),
        F.bround("precision_proxy", 4).alias("estimated_precision_proxy"), "languages", "source_support", "status", F.lit("review before use").alias("recommended_action"),
        F.lit(created_at).alias("created_at"), F.lit(False).alias("derived_from_errors"),
    )


def error_proposals(wrong: DataFrame, k: int = 50, least: int = 2) -> DataFrame:
    """Recurring tokens of missed phishing and of false alarms, and domains of missed phishing; in that order."""

    def recurring(kind):
        tokens = F.array_distinct(F.filter(F.regexp_extract_all(F.lower("text_snippet"), F.lit(PROPOSAL_TOKEN), F.lit(0)), lambda t: F.length(t) >= 5))
        rows = wrong.where(F.col("error_type") == kind).select(F.explode(tokens).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
        return rows.where(F.col("n") >= least).orderBy(F.desc("n"), "pattern").limit(k)

    missed = recurring("false_negative").select(F.lit("phishing_signal").alias("kind"), "pattern", "n", F.lit(1.0).alias("precision_proxy"))
    false = recurring("false_positive").select(F.lit("benign_suppression").alias("kind"), "pattern", "n", F.lit(0.0).alias("precision_proxy"))
    dom = wrong.where("error_type = 'false_negative' and registered_domain is not null").groupBy(F.col("registered_domain").alias("pattern")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "pattern").limit(5)
    rows = missed.union(false).union(dom.select(F.lit("domain_escalation").alias("kind"), "pattern", "n", F.lit(0.5).alias("precision_proxy")))
    order = F.when(F.col("kind") == "phishing_signal", 0).when(F.col("kind") == "benign_suppression", 1).otherwise(2)
    return rows.orderBy(order, F.desc("n"), "pattern").limit(k)

