"""Source adapters: each turns a snapshot into raw records. Registered by name, so more can be added."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import scalars
from lakemill.functions.scalars import CANDIDATES, clean_text, pick_first
from lakemill.plans.canonical import raw
from lakemill.sources import readers

Adapter = Callable[..., DataFrame]
_REGISTRY: dict[str, Adapter] = {}


def register(name: str):
    def add(f: Adapter) -> Adapter:
        if name in _REGISTRY:
            raise ValueError(f"adapter {name!r} is registered already")
        _REGISTRY[name] = f
        return f

    return add


def adapter(name: str) -> Adapter:
    if name not in _REGISTRY:
        raise KeyError(f"no adapter {name!r}; there are {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name]


def names() -> list[str]:
    return sorted(_REGISTRY)


def _pick(df: DataFrame, role: str) -> Column:
    return clean_text(pick_first(df.columns, CANDIDATES[role]))


#: Columns of a row's place in its file.
PLACE = ["__path", "__file", "__row"]


def _id(own: Column | None = None) -> Column:
    """A row's own id, else its file and number."""
    made = F.concat_ws(":", "__file", "__row")
    return made if own is None else F.coalesce(own, made)


def _below(root: str) -> Column:
    """A file's path below the snapshot's root."""
    root = root.rstrip("/").removeprefix("file://").removeprefix("file:") + "/"
    at = F.locate(root, F.col("path"))
    return F.when(at > 0, F.substring(F.col("path"), at + F.lit(len(root)), F.length("path"))).otherwise(F.regexp_extract("path", r"([^/]*/[^/]*)$", 1))


def _placed(df: DataFrame, **columns) -> DataFrame:
    return raw(df, **columns, path=F.col("__path"), row=F.col("__row"))


def _page_rows(spark: SparkSession, path: str, source: str, phishing, benign) -> DataFrame:
    df = readers.read_rows(spark, path)
    url, html, text = (_pick(df, r) for r in ("url", "html", "text"))
    moved = scalars.looks_like_html(text) & html.isNull()
    html = F.when(moved, text).otherwise(html)
    text = F.when(~F.coalesce(moved, F.lit(False)) & ~F.coalesce(text == html, F.lit(False)), text)
    used = [pick for r in CANDIDATES for pick in CANDIDATES[r]] + PLACE
    label = _pick(df, "label")
    out = _placed(
        df,
        source=F.lit(source),
        original_id=_id(_pick(df, "id")),
        original_label=label,
        given_label=scalars.binary_label(label, phishing, benign),
        url=url,
        html=html,
        text=text,
        timestamp=_pick(df, "timestamp"),
        language=_pick(df, "language"),
        split=F.coalesce(_pick(df, "split"), scalars.split_from_path("__file")),
        metadata=scalars.rest_as_map(df.columns, used),
    )
    return out.where("url is not null or html is not null or text is not null")


@register("phreshphish")
def web_pages(spark: SparkSession, path: str) -> DataFrame:
    return _page_rows(spark, path, "phreshphish", ("phish", "phishing", "1", "true", "malicious"), ("benign", "legitimate", "0", "false"))


@register("mendeley")
def labelled_pages(spark: SparkSession, path: str, phishing=("phish", "phishing", "malicious", "1"), benign=("benign", "legitimate", "legit", "0")) -> DataFrame:
    """A structured file, or a folder of raw pages in folders named by label, with URL files beside them."""
    if readers.suffix_of(path) in readers.READERS:
        return _page_rows(spark, path, "mendeley", phishing, benign)
    files = readers.read_raw_files(spark, path)
    pages = files.where(F.col("suffix").isin("html", "htm", "txt"))
    links = files.where(F.col("suffix").isin("url", "link")).groupBy("stem").agg(F.min(F.trim(F.split_part("value", F.lit("\n"), F.lit(1)))).alias("link"))
    rows = pages.join(links, "stem", "left").withColumn("l", scalars.label_from_path("path"))
    as_text = F.col("suffix") == "txt"
    return raw(rows, source=F.lit("mendeley"), original_id=_below(path), original_label=F.col("l"), given_label=scalars.binary_label("l"), url=clean_text("link"), html=F.when(~as_text, F.col("value")), text=F.when(as_text, F.col("value")), split=scalars.split_from_path("path"), path=F.col("path"), row=F.lit(1))


@register("openphish")
def url_feed(spark: SparkSession, path: str) -> DataFrame:
    if readers.suffix_of(path) == "txt":
        rows = readers.read_lines(spark, path)
        url = scalars.first_url("line")
        rest = F.trim(F.expr("replace(line, regexp_extract(line, '(?i)https?://\\\\S+', 0), '')"))
        rows = rows.withColumns({"u": url, "rest": rest}).where("u is not null")
        meta = F.map_filter(F.create_map(F.lit("raw_line"), F.when(F.col("line") != F.col("u"), F.col("line"))), lambda _, v: v.isNotNull())
        return raw(rows, source=F.lit("openphish"), original_id=F.concat_ws(":", F.regexp_extract("path", r"([^/]*)$", 1), "line_number"), original_label=F.lit("phishing"), given_label=F.lit(1), url=F.col("u"), timestamp=scalars.timestamp_text("rest"), metadata=meta, path=F.col("path"), row=F.col("line_number"))
    df = readers.read_rows(spark, path)
    out = _placed(df, source=F.lit("openphish"), original_id=_id(_pick(df, "id")), original_label=F.lit("phishing"), given_label=F.lit(1), url=_pick(df, "url"), timestamp=_pick(df, "timestamp"), metadata=scalars.rest_as_map(df.columns, [*CANDIDATES["url"], *CANDIDATES["timestamp"], *PLACE]))
    return out.where("url is not null")


@register("phishtank")
def verified_feed(spark: SparkSession, path: str) -> DataFrame:
    if readers.suffix_of(path) == "xml":
        df = readers.positioned(readers.read_xml(spark, path))
        flat = {"url": "url", "phish_id": "phish_id", "verified": "verification.verified", "verification_time": "verification.verification_time", "submission_time": "submission.submission_time", "online": "status.online", "target": "target", "details": "details"}
        have = {f.name: f.dataType for f in df.schema.fields}
        found = {n: p for n, p in flat.items() if p.split(".")[0] in have and ("." not in p or p.split(".")[1] in getattr(have[p.split(".")[0]], "names", []))}
        df = df.select(*[(F.to_json(p) if n == "details" else F.col(p).cast("string")).alias(n) for n, p in found.items()], *PLACE)
    else:
        df = readers.read_rows(spark, path)
    low = {c.lower() for c in df.columns}
    get = lambda n: clean_text(n) if n in low else F.lit(None).cast("string")
    verified = F.lower(get("verified"))
    label = F.when(verified.isin("yes", "true", "valid", "verified", "1"), 1).when(verified.isin("no", "false", "0"), 0).when(verified.isNull() & F.col("__file").contains("online-valid"), 1)
    out = _placed(df, source=F.lit("phishtank"), original_id=_id(get("phish_id")), original_label=get("verified"), given_label=label, url=get("url"), timestamp=F.coalesce(get("verification_time"), get("submission_time")), metadata=scalars.rest_as_map(df.columns, ["url", "phish_id", *PLACE]))
    return out.where("url is not null")


@register("uci_phishing")
def tabular(spark: SparkSession, path: str) -> DataFrame:
    """The label is the first known label column, else the last one; -1 is phishing, 1 is not, 0 is neither."""
    df = readers.read_rows(spark, path)
    given = [c for c in df.columns if c not in PLACE]
    low = {c.lower(): c for c in given}
    label = next((low[c] for c in CANDIDATES["label"] if c in low), given[-1])
    value = clean_text(F.col(f"`{label}`"))
    given = F.when(value.isin("-1", "-1.0"), 1).when(value.isin("1", "1.0"), 0)
    return _placed(df, source=F.lit("uci_phishing"), original_id=_id(), original_label=value, given_label=given, tabular=scalars.rest_as_map(df.columns, [label, *PLACE]))


@register("oscar_aux")
def auxiliary_text(spark: SparkSession, path: str, language: str | None = None, config_name: str = "") -> DataFrame:
    """Unlabelled text; the language is given, in the data, or the ending of the configuration's name."""
    given = language or (config_name.rsplit("_", 1)[-1] if "_" in config_name else None)
    if readers.suffix_of(path) == "txt":
        rows = readers.read_lines(spark, path, skip_comments=False)
        return raw(rows, source=F.lit("oscar_aux"), original_id=F.concat_ws(":", F.regexp_extract("path", r"([^/]*)$", 1), "line_number"), text=F.col("line"), language=F.lit(given), path=F.col("path"), row=F.col("line_number"))
    df = readers.read_rows(spark, path)
    out = _placed(df, source=F.lit("oscar_aux"), original_id=_id(_pick(df, "id")), text=_pick(df, "text"), language=F.coalesce(_pick(df, "language"), F.lit(given)), split=_pick(df, "split"), metadata=scalars.rest_as_map(df.columns, [*CANDIDATES["text"], *CANDIDATES["language"], *PLACE]))
    return out.where("text is not null")


#: Sources whose folders hold raw pages, which their adapter reads itself where a folder has no structured file.
RAW_FOLDERS = ("mendeley",)


def load_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A source's snapshot: one file, or all files of known formats in a folder."""
    if name in RAW_FOLDERS:
        reads = [r for r in readers.snapshot_reads(spark, path) if readers.suffix_of(r) != "txt"]
        parts = [adapter(name)(spark, r) for r in reads or [path]]
    else:
        parts = [adapter(name)(spark, r) for r in readers.snapshot_reads(spark, path)]
    if not parts:
        raise FileNotFoundError(f"no file of a known format under {path}")
    return reduce(DataFrame.unionByName, parts)


def in_order() -> list[Column]:
    """The order of a source's rows: by file, folders compared name by name, then by row."""
    return [F.translate("path", "/", "\x01"), F.col("row")]


def load_sources(spark: SparkSession, snapshots: dict[str, str], caps: dict[str, int] | None = None) -> DataFrame:
    """All sources as one frame; ``source_rank``, ``path`` and ``row`` give the order of its rows."""
    parts = []
    for rank, name in enumerate(sorted(snapshots)):
        rows = load_source(spark, name, snapshots[name])
        if caps and name in caps:
            rows = rows.orderBy(*in_order()).limit(caps[name])
        parts.append(rows.withColumn("source_rank", F.lit(rank)))
    if not parts:
        raise ValueError("no sources")
    return reduce(DataFrame.unionByName, parts)


def readiness(spark: SparkSession, name: str, path: str) -> dict:
    """Whether a snapshot yields records."""
    try:
        n = load_source(spark, name, path).limit(3).count()
    except Exception as e:  # noqa: BLE001  the report carries what went wrong
        return {"dataset": name, "status": "not_ready", "reason": f"{type(e).__name__}: {e}"[:300]}
    return {"dataset": name, "status": "ready" if n else "empty", "previewed": n}
