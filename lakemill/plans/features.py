"""More queries of the catalogue: model features, domains, evidence of proposals, times and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions import urls
from lakemill.functions.suffixes import COMMON_RULES
from lakemill.functions.times import normalized_time
from lakemill.operators import adaptive, encoders, fusion, metrics, models, splits, vectorizer
from lakemill.plans.catalogue import _ACTS, _CONF, _ERR, _F1, HTML_FLAGS, IS_IP, KEYWORDS, ODD_PARTS, PRED, URL_FLAGS, _errors, _pages, predictions, query, r6, table
from lakemill.plans.samples import odd_pages

# --- vectors -------------------------------------------------------------------------------------

_MODEL_FEATURES = {
    "is_ip_address": f"{IS_IP}::INT",
    "has_punycode": "contains(host, 'xn--')::INT",
    "has_percent_encoding": "regexp_matches(url, '%[0-9a-fA-F]{2}')::INT",
    "url_length": "length(url)",
    "path_length": "length(u.path)",
    "query_length": "length(u.query)",
    "num_subdomains": f"CASE WHEN {IS_IP} THEN 0 ELSE greatest(len(string_split(host, '.')) - 2, 0) END",
    "suspicious_keyword_count": f"len(list_filter({KEYWORDS}, lambda w: contains(lower(url), w)))",
    "digit_count": "len(regexp_extract_all(url, '[0-9]'))",
    "digit_ratio": "round_even(len(regexp_extract_all(url, '[0-9]')) / length(url)::DOUBLE, 6)",
    "hostname_digit_count": "len(regexp_extract_all(host, '[0-9]'))",
    "contains_at_symbol": "contains(url, '@')::INT",
    "contains_double_slash_path": "contains(u.path, '//')::INT",
    "contains_hyphenated_hostname": "contains(host, '-')::INT",
    "path_depth": "len(list_filter(string_split(u.path, '/'), lambda p: p <> ''))",
    "query_param_count": "CASE WHEN u.query = '' THEN 0 ELSE len(string_split(u.query, '&')) END",
}
_ENTRIES = ", ".join(f"{{'k': '{k}', 'v': ({v})::DOUBLE}}" for k, v in _MODEL_FEATURES.items())


@query(f"""WITH {ODD_PARTS}, e AS (SELECT page_id, unnest([{_ENTRIES}]) AS e FROM x), n AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS position FROM (SELECT DISTINCT e.k AS k FROM e))
SELECT page_id, position::INT AS position, e.k AS feature, e.v AS value FROM e JOIN n ON e.k = n.k WHERE e.v <> 0""")
def url_vectors(spark, d):
    """The vectors that the URL forest learns from."""
    rows = models.url_feature_terms(urls.with_url(odd_pages(table(spark, d, "pages")), "url"))
    model, names = vectorizer.fit(rows)
    return vectorizer.long_form(model.transform(rows), "page_id", names)


@query("""WITH e AS (SELECT p_partkey, unnest([{'k': 'size', 'v': p_size::DOUBLE}, {'k': 'brand=' || p_brand, 'v': 1.0}, {'k': 'dear', 'v': (p_retailprice > 1200)::INT::DOUBLE},
  {'k': CASE WHEN p_partkey % 3 = 0 THEN 'extra' ELSE 'extra=' || p_name END, 'v': CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE 1.0 END}, {'k': CASE WHEN p_partkey % 5 > 0 THEN 'type=' || p_type END, 'v': 1.0}]) AS e FROM part),
n AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS position FROM (SELECT DISTINCT e.k AS k FROM e WHERE e.k IS NOT NULL))
SELECT p_partkey, position::INT AS position, e.k AS feature, e.v AS value FROM e JOIN n ON e.k = n.k WHERE e.v <> 0""")
def dictionary_vectors(spark, d):
    """Parts as VARIANT objects: numbers, booleans, strings, nulls, and a key that holds numbers here and strings there."""
    p = F.col("p_partkey")
    some = F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand"), (F.col("p_retailprice") > 1200).alias("dear"), F.when(p % 5 > 0, F.col("p_type")).alias("type"))
    of = lambda extra: F.to_json(F.struct(*[some[n].alias(n) for n in ("size", "brand", "dear", "type")], extra.alias("extra")), {"ignoreNullFields": "false"})
    text = F.when(p % 3 == 0, of(F.col("p_retailprice"))).otherwise(of(F.col("p_name")))
    rows = vectorizer.dictionary_terms(table(spark, d, "part").select("p_partkey", F.parse_json(text).alias("object")), "object")
    model, names = vectorizer.fit(rows)
    return vectorizer.long_form(model.transform(rows), "p_partkey", names)


@query("""WITH w AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> '')[1:256] AS w FROM documents), t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS x, coalesce(length(w[unnest(range(1, len(w) + 1)) + 1]), 0) AS after FROM w)
SELECT doc_id, round(coalesce(avg(length(x)), 0), 6) AS mean_length, round(coalesce(avg(k - 1), 0), 6) AS mean_place, round(coalesce(avg(after), 0), 6) AS mean_after FROM documents LEFT JOIN t USING (doc_id) GROUP BY doc_id""")
def encoder_pooling(spark, d):
    """Documents through an encoder's batches, its mask and the pooling of its states; 256 tokens are the encoder's length."""
    rows = encoders.encode(table(spark, d, "documents").select("doc_id", "text"), encoders.WordShapes)
    return rows.select("doc_id", *[F.round(F.col("embedding")[k], 6).alias(n) for k, n in enumerate(("mean_length", "mean_place", "mean_after"))])


# --- domains -------------------------------------------------------------------------------------

#: What the page's number makes of the last two labels of its host.
TOPS = ("co.uk", "kobe.jp", "city.kobe.jp", "shop.kobe.jp", "ck", "www.ck", "beds.sch.uk", "uk", "com", "com.br", "gov.np", "a.b.c.mm", "unlisted", "sch.uk")
_HOST_SQL = f"regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '[^.]+\\.[^.]+$', '') || CASE WHEN page_id % 3 = 0 THEN '' ELSE 'site.' END || {list(TOPS)!r}[page_id % {len(TOPS)} + 1]"
_RULES = ", ".join(f"('{r}')" for r in COMMON_RULES)


@query(f"""WITH p AS (SELECT page_id, ltrim(replace({_HOST_SQL}, '..', '.'), '.') AS host FROM pages), h AS (SELECT page_id, host, string_split(host, '.') AS l FROM p), r AS (SELECT ltrim(rule, '!') AS rule, starts_with(rule, '!') AS excepted FROM (VALUES {_RULES}) AS t(rule)),
t AS (SELECT page_id, k, array_to_string(l[len(l) - k + 1:], '.') AS tail, '*.' || array_to_string(l[len(l) - k + 2:], '.') AS above FROM (SELECT *, unnest(range(1, len(l) + 1)) AS k FROM h)),
m AS (SELECT page_id, max(k - 1) FILTER (excepted) AS e, max(k) FILTER (NOT excepted) AS n FROM t JOIN r ON rule = tail OR NOT excepted AND rule = above GROUP BY page_id),
s AS (SELECT h.*, coalesce(e, n, 1) AS k FROM h LEFT JOIN m USING (page_id))
SELECT page_id, host, CASE WHEN len(l) > 1 THEN array_to_string(l[greatest(len(l) - k, 0) + 1:], '.') END AS suffix, array_to_string(l[greatest(len(l) - k - 1, 0) + 1:], '.') AS registered_domain, CASE WHEN len(l) > k + 1 THEN array_to_string(l[:len(l) - k - 1], '.') END AS subdomain, greatest(len(l) - k - 1, 0)::BIGINT AS subdomains FROM s""")
def url_domains(spark, d):
    """Registered domains under rules with wildcards and exceptions."""
    k = F.col("page_id")
    front = F.regexp_replace(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), r"[^.]+\.[^.]+$", "")
    top = F.element_at(F.array(*map(F.lit, TOPS)), (k % len(TOPS) + 1).cast("int"))
    host = F.ltrim(F.replace(F.concat(front, F.when(k % 3 == 0, "").otherwise("site."), top), F.lit(".."), F.lit(".")), F.lit("."))
    rows = urls.with_url(table(spark, d, "pages").select("page_id", F.concat(F.lit("http://"), host, F.lit("/")).alias("u")), "u")
    f = F.col("url_features")
    return rows.select("page_id", f["hostname"].alias("host"), *[f[n].alias(n) for n in ("suffix", "registered_domain", "subdomain")], f["num_subdomains"].cast("long").alias("subdomains"))


# --- evidence of proposals -----------------------------------------------------------------------


def _evidence_sql(parts: str, rows: str, chosen: str, once: bool, whole_languages: bool = False) -> str:
    """``rows``: (seq, y, source, language, t), t being a row's patterns in order; ``chosen`` picks from q."""
    own = "list_distinct(t)" if once else "t"
    languages = "(SELECT string_agg(DISTINCT language, ',' ORDER BY language) FROM w WHERE y = 1 AND language <> '')" if whole_languages else "e.languages"
    return f"""WITH {parts}w AS MATERIALIZED ({rows}), r AS (SELECT y, unnest(t) AS pattern FROM w WHERE y IN (0, 1)),
g AS (SELECT pattern, count(*) FILTER (y = 1) AS phishing, count(*) FILTER (y = 0) AS benign FROM r GROUP BY pattern), q AS (SELECT *, phishing::DOUBLE / greatest(1, phishing + benign) AS proxy FROM g),
c AS MATERIALIZED ({chosen}), o AS (SELECT seq, source, language, unnest({own}) AS pattern, generate_subscripts({own}, 1) AS pos FROM w WHERE y = 1), f AS MATERIALIZED (SELECT o.* FROM o JOIN c USING (pattern)),
s AS (SELECT pattern, string_agg(source || ':' || n::VARCHAR, ',' ORDER BY source) AS support FROM (SELECT pattern, source, count(*) AS n FROM f GROUP BY ALL) GROUP BY pattern),
e AS (SELECT pattern, string_agg(seq::VARCHAR, ',' ORDER BY k) AS examples, string_agg(DISTINCT language, ',' ORDER BY language) FILTER (language <> '') AS languages FROM (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY seq, pos) AS k FROM f) WHERE k <= 3 GROUP BY pattern)
SELECT c.pattern, phishing, benign, round(proxy, 6) AS proxy, coalesce({languages}, '') AS languages, support, examples FROM c JOIN s USING (pattern) JOIN e USING (pattern)"""


def _shown(found: DataFrame) -> DataFrame:
    support = F.array_join(F.transform(F.array_sort(F.map_entries("source_support")), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    examples = F.array_join(F.transform("examples", lambda e: e["sample_id"]), ",")
    return found.select("pattern", "phishing", "benign", r6("precision_proxy", "proxy"), F.array_join("languages", ",").alias("languages"), support.alias("support"), examples.alias("examples"))


_GRAMS = "t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) || list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])"


@query(
    _evidence_sql(
        "",
        rf"SELECT seq, y, source, language, {_GRAMS} AS t FROM (SELECT doc_id AS seq, toxic AS y, source, lang AS language, regexp_extract_all(lower(text), '[\p{{L}}0-9_-]{{4,}}')[1:80] AS t FROM labels JOIN documents USING (doc_id))",
        "SELECT * FROM (SELECT * FROM q WHERE phishing >= 3 ORDER BY phishing DESC, pattern LIMIT 150) WHERE proxy >= 0.2",
        once=True,
    )
)
def evidence_phrases(spark, d):
    rows = predictions(spark, d).withColumnsRenamed({"text": "normalized_text", "source": "source_dataset"})
    rows = rows.withColumns({"seq": F.col("sample_id"), "sample_id": F.col("sample_id").cast("string")})
    return _shown(adaptive.phrase_proposals(rows, floor=0.2, evidence=True))


_PAGE_ROWS = "SELECT page_id AS seq, page_id // 5 % 2 AS y, 'web' || (page_id % 3)::VARCHAR AS source, nullif(split_part(replace(lower(regexp_extract(html, '(?i)<html[^>]*\\blang=[''\"]?([a-zA-Z_-]+)', 1)), '_', '-'), '-', 1), '') AS language, {} AS t FROM x"
_TWO = "SELECT * FROM q WHERE phishing >= 2"


@query(_evidence_sql(f"{ODD_PARTS}, ", _PAGE_ROWS.format(f"list_transform({_ACTS}, lambda z: lower(z))"), "SELECT * FROM (SELECT * FROM q WHERE phishing >= 2 ORDER BY phishing DESC, pattern LIMIT 50) WHERE proxy >= 0.65", once=False))
def evidence_actions(spark, d):
    return _shown(adaptive.cta_proposals(_pages(spark, d), evidence=True))


@query(_evidence_sql(f"{ODD_PARTS}, ", _PAGE_ROWS.format(URL_FLAGS), _TWO, once=False, whole_languages=True))
def evidence_url_style(spark, d):
    return _shown(adaptive.url_proposals(_pages(spark, d), evidence=True))


@query(_evidence_sql(f"{ODD_PARTS}, ", _PAGE_ROWS.format(HTML_FLAGS), _TWO, once=False, whole_languages=True))
def evidence_html_pattern(spark, d):
    return _shown(adaptive.html_proposals(_pages(spark, d), evidence=True))


# --- drift ---------------------------------------------------------------------------------------

_TOP_SQL = f"CASE WHEN doc_id % 5 = 0 THEN NULL ELSE {list(TOPS)!r}[(doc_id // 2) % {len(TOPS)} + 1] END"
_DRIFT_ROWS = f"""b AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'reference' ELSE 'current' END AS side, coalesce(toxic::VARCHAR, 'None') AS label, coalesce(lang, 'unknown') AS language, source, coalesce({_TOP_SQL}, 'unknown') AS tld, CASE WHEN toxic IS NOT NULL THEN doc_id % 97 / 96.0::DOUBLE END AS score, text FROM documents LEFT JOIN labels USING (doc_id))"""
_LONG = "list_filter(string_split_regex(lower(text), '\\s+'), lambda t: length(t) >= 4)[1:200]"


@query(f"""WITH {_DRIFT_ROWS}, h AS (SELECT dim, value, count(*) FILTER (side = 'reference') AS reference, count(*) FILTER (side = 'current') AS current FROM (SELECT side, unnest(['label', 'language', 'source', 'tld']) AS dim, unnest([label, language, source, tld]) AS value FROM b) GROUP BY ALL),
p AS (SELECT *, reference / sum(reference) OVER (PARTITION BY dim) AS p, current / sum(current) OVER (PARTITION BY dim) AS q FROM h), j AS (SELECT dim, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS js FROM p GROUP BY dim),
t AS (SELECT side, unnest({_LONG}) AS token FROM b), c AS (SELECT token, count(*) FILTER (side = 'reference') AS reference, count(*) FILTER (side = 'current') AS current FROM t GROUP BY token ORDER BY abs(current - reference) DESC, token LIMIT 25),
s AS (SELECT avg(score) FILTER (side = 'reference') AS a, avg(score) FILTER (side = 'current') AS b, stddev_pop(score) FILTER (side = 'reference') AS x, stddev_pop(score) FILTER (side = 'current') AS y FROM b),
r AS (SELECT 'rows' AS section, 'count' AS item, count(*) FILTER (side = 'reference') AS reference, count(*) FILTER (side = 'current') AS current, count(*) FILTER (side = 'current') - count(*) FILTER (side = 'reference') AS measure FROM b
  UNION ALL SELECT dim, value, reference, current, js FROM h JOIN j USING (dim) UNION ALL SELECT 'score', 'mean', a, b, b - a FROM s UNION ALL SELECT 'score', 'std', x, y, y - x FROM s UNION ALL SELECT 'token', token, reference, current, current - reference FROM c)
SELECT section, item, round(reference::DOUBLE, 6) AS reference, round(current::DOUBLE, 6) AS current, round(measure::DOUBLE, 6) AS measure FROM r""")
def drift_report(spark, d):
    """Labels, languages, sources, domains, scores and tokens of even documents against odd ones."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    top = F.when(F.col("doc_id") % 5 != 0, F.element_at(F.array(*map(F.lit, TOPS)), (F.floor(F.col("doc_id") / 2) % len(TOPS) + 1).cast("int")))
    score = F.when(F.col("toxic").isNotNull(), F.col("doc_id") % 97 / F.lit(96.0))
    rows = rows.select("doc_id", F.col("toxic").alias("normalized_label"), F.col("lang").alias("language"), F.col("source").alias("source_dataset"), F.struct(top.alias("suffix")).alias("url_features"), score.alias("score"), F.col("text").alias("normalized_text"))
    found = adaptive.drift_report(rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 <> 0"))
    return found.select("section", "item", *[r6(c, c) for c in ("reference", "current", "measure")])


_SPACED = f"""WITH {PRED}, t AS (SELECT DISTINCT t FROM (SELECT round(i / 199.0, 6)::DOUBLE AS t FROM range(200) AS x(i) UNION ALL SELECT unnest([0.0, 0.5, 1.0])::DOUBLE) WHERE (SELECT count(DISTINCT score) FROM p) > 200 UNION SELECT score FROM p WHERE (SELECT count(DISTINCT score) FROM p) <= 200 UNION SELECT unnest([0.0, 0.5, 1.0])::DOUBLE),
c AS (SELECT t, count(*) FILTER (label = 1 AND score >= t) AS tp, count(*) FILTER (label = 0 AND score >= t) AS fp, count(*) FILTER (label = 0 AND score < t) AS tn, count(*) FILTER (label = 1 AND score < t) AS fn FROM p, t GROUP BY t)"""


@query(f"{_SPACED} SELECT round(t, 6) AS threshold, tp, fp, tn, fn, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c")
def threshold_table_spaced(spark, d):
    """Scores as they are: at most 200 distinct ones are thresholds themselves, more give way to evenly spaced ones."""
    return metrics.threshold_table(predictions(spark, d)).select("threshold", *[F.col(c).cast("long").alias(c) for c in ("tp", "fp", "tn", "fn")], r6("f1", "f1"))


# --- times and splits ----------------------------------------------------------------------------


def _times(spark, d) -> DataFrame:
    """``events`` with their times written in six forms, left out, or not times at all."""
    ts, k = F.col("ts"), F.col("event_id") % 8
    date, clock = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")
    text = (
        F.when(k == 0, date).when(k == 1, F.concat(date, F.lit("T"), clock, F.lit("Z"))).when(k == 2, F.concat(F.lit(" "), date, F.lit(" "), F.date_format(ts, "HH:mm:ss.SSS")))
        .when(k == 3, F.date_format(ts, "yyyyMMdd'T'HHmmss'+0530'")).when(k == 4, F.concat(date, F.lit("T"), F.date_format(ts, "HH:mm"))).when(k == 5, F.concat(F.lit("late "), F.col("event_id").cast("string"))).when(k == 6, _week_date(ts))
    )
    return table(spark, d, "events").withColumn("text", text)


def _week_date(ts):
    """A week date."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"), F.lit("-"), (F.weekday(ts) + 1).cast("string"))


_TIMES = """t AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S') AS c, strftime(ts, '%g') AS ms, ts FROM events),
n AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN d || 'T00:00:00' WHEN 1 THEN d || 'T' || c || '+00:00' WHEN 2 THEN d || 'T' || c || CASE WHEN ms = '000' THEN '' ELSE '.' || ms || '000' END WHEN 3 THEN d || 'T' || c || '+05:30'
  WHEN 4 THEN d || 'T' || strftime(ts, '%H:%M') || ':00' WHEN 5 THEN 'late ' || event_id::VARCHAR WHEN 6 THEN d || 'T00:00:00' END AS normal FROM t)"""


@query(f"WITH {_TIMES} SELECT event_id, normal FROM n")
def times_normalized(spark, d):
    return _times(spark, d).select("event_id", normalized_time(F.col("text")).alias("normal"))


@query(f"""WITH {_TIMES}, x AS (SELECT event_id, count(*) OVER () AS n, row_number() OVER (ORDER BY normal IS NULL, coalesce(normal, event_id::VARCHAR), event_id) AS r FROM n)
SELECT event_id, CASE WHEN r > n - greatest(1, round_even(n * 0.2, 0)) THEN 'test' WHEN r > n - greatest(1, round_even(n * 0.2, 0)) - greatest(1, round_even(n * 0.1, 0)) THEN 'validation' ELSE 'train' END AS split FROM x""")
def split_by_mixed_times(spark, d):
    return splits.time_aware(_times(spark, d), "event_id", F.col("text")).select("event_id", "split")


_RANDOM_SQL = """SELECT {0} AS asked, {1} AS reason, split, count(*) AS n FROM (SELECT CASE WHEN r <= t THEN 'test' WHEN r <= t + v THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT {2}, row_number() OVER ({3} ORDER BY sha256('42:' || doc_id::VARCHAR), doc_id) AS r FROM labels {4})) GROUP BY split"""
_EVEN = "greatest(1, round_even(count(*) OVER (PARTITION BY toxic) * 0.2, 0)) AS t, greatest(1, round_even(count(*) OVER (PARTITION BY toxic) * 0.1, 0)) AS v"
_UNEVEN = "ceil(count(*) OVER () * 0.2) AS t, ceil((count(*) OVER () - ceil(count(*) OVER () * 0.2)) * (0.1 / (1 - 0.2))) AS v"


@query(
    " UNION ALL ".join(
        [
            _RANDOM_SQL.format("'group'", "'insufficient_distinct_groups'", _EVEN, "PARTITION BY toxic", ""),
            _RANDOM_SQL.format("'predefined'", "'missing_or_incomplete_source_splits'", _EVEN, "PARTITION BY toxic", ""),
            _RANDOM_SQL.format("'stratified'", "NULL", _UNEVEN, "", ""),
        ]
    )
)
def split_fallbacks(spark, d):
    """A single group, sources that name no test rows, and labels other than 0 and 1; a row a split comes back from each."""
    rows = table(spark, d, "labels").withColumns({"own": F.when(F.col("doc_id") % 3 == 0, "train").otherwise("valid"), "three": F.col("toxic") + F.col("quality")})
    found = []
    for strategy, label in (("group", "toxic"), ("predefined", "toxic"), ("stratified", "three")):
        made, report = splits.split_with_report(rows, strategy, "doc_id", label, group=F.lit("all"), split_col="own")
        found.append(made.groupBy("split").agg(F.count(F.lit(1)).alias("n")).select(F.lit(strategy).alias("asked"), F.lit(report["fallback_reason"]).cast("string").alias("reason"), "split", "n"))
    return found[0].union(found[1]).union(found[2])


# --- errors and runs -----------------------------------------------------------------------------


@query(f"""{_ERR}, r AS (SELECT error_type, unnest(['language', 'source', 'domain', 'tld']) AS dim, unnest([coalesce(nullif(language, ''), 'unknown'), coalesce(nullif(source, ''), 'unknown'), registered_domain, CASE WHEN sample_id % 3 = 0 THEN 'unknown' ELSE 'com' END]) AS value FROM e)
SELECT dim, value, count(*) FILTER (error_type = 'false_positive') AS false_positives, count(*) FILTER (error_type = 'false_negative') AS false_negatives FROM r GROUP BY ALL""")
def errors_rollups(spark, d):
    return adaptive.error_rollups(_errors(spark, d).withColumn("suffix", F.when(F.col("sample_id") % 3 != 0, "com")))


_RUN_SQL = f"""WITH {PRED}, c AS (SELECT source, language, count(*) AS n, {_CONF} FROM p GROUP BY ALL), k AS (SELECT *, length(source || language) % 3 AS shape FROM c)
SELECT 'webpage_text:' || source || ':' || language AS run_id, language AS run_name, 'webpage' AS track_group, CASE WHEN shape = 0 THEN 'group' ELSE 'stratified' END AS split_strategy, n::DOUBLE AS sample_count, round({_F1}, 6) AS f1, CASE WHEN shape < 2 THEN tp END AS tp, CASE WHEN shape < 2 THEN fn END AS fn,
CASE shape WHEN 0 THEN '{{"null":' || fp::VARCHAR || '}}' WHEN 1 THEN '{{"null":' || fn::VARCHAR || '}}' END AS excluded_counts, CASE WHEN shape = 2 THEN '["text","' || source || '"]' END AS input_fields, shape = 1 AS server_side_inference_only FROM k"""


@query(_RUN_SQL)
def run_rows(spark, d):
    """Runs by source and language, whose summaries have three shapes, and broken documents, which have no row."""
    c = metrics.confusion(predictions(spark, d), ["source", "language"])
    shape = F.length(F.concat("source", "language")) % 3
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    matrix = F.when(shape < 2, F.struct("tn", "fp", "fn", "tp"))
    excluded = lambda k, c: F.when(shape == k, F.struct(F.col(c).alias("null")))
    of_split = F.struct(n.alias("sample_count"), "f1", matrix.alias("confusion_matrix"))
    document = F.to_json(
        F.struct(
            F.lit("webpage_text").alias("track"), F.col("source").alias("model_name"), excluded(0, "fp").alias("excluded_counts"), F.when(shape == 1, F.lit(True)).alias("server_side_inference_only"),
            F.struct(of_split.alias("test"), excluded(1, "fn").alias("excluded_counts"), F.when(shape != 0, "stratified").alias("split_strategy")).alias("metrics"),
            F.struct(F.when(shape == 0, F.struct(F.lit("group").alias("strategy"))).alias("split"), F.when(shape == 2, F.array(F.lit("text"), "source")).alias("input_fields")).alias("config"),
        )
    )
    documents = c.select(F.concat(F.lit("/runs/"), "source", F.lit("/"), "language").alias("run_dir"), document.alias("document"))
    broken = c.select(F.lit("/runs/x").alias("run_dir"), F.explode(F.array(F.lit("{"), F.lit("[1]"), F.lit('{"metrics": {"test": 3}}'))).alias("document"))
    found = fusion.run_rows(documents.union(broken))
    return found.select("run_id", "run_name", "track_group", "split_strategy", "sample_count", r6("f1", "f1"), "tp", "fn", "excluded_counts", "input_fields", "server_side_inference_only")
