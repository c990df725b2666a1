"""Readers and adapters on small files."""

import bz2
import gzip
import json

import pytest

from lakemill.sources import adapters, readers, sinks


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text.encode()
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else bz2.compress(data) if path.suffix == ".bz2" else data)
    return str(path)


def test_csv_delimiters_and_compression(spark, tmp_path):
    for name, sep in (("a.csv", ","), ("b.csv.gz", ";"), ("c.tsv.bz2", "\t"), ("d.csv", "|")):
        rows = readers.read_any(spark, put(tmp_path / name, f'x{sep}y\n1{sep}"a\nb"\n{sep}NA\n')).collect()
        assert [tuple(r) for r in rows] == [("1", "a\nb"), ("", "NA")]


def test_json_shapes(spark, tmp_path):
    rows = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    shapes = [rows, {"items": rows, "n": 2}, {"k1": rows[0], "k2": rows[1]}]
    for k, doc in enumerate(shapes):
        got = readers.read_any(spark, put(tmp_path / f"s{k}.json", json.dumps(doc))).select("a", "b").collect()
        assert sorted(map(tuple, got)) == [("1", "x"), ("2", None)]
    got = readers.read_any(spark, put(tmp_path / "r.jsonl", '{"a": 1, "b": {"c": 2}}\n\n{"a": 2}\n')).collect()
    assert sorted((r["a"], r["b"]) for r in got if r["a"] == "1") == [("1", '{"c":2}')]
    with pytest.raises(ValueError):
        readers.read_any(spark, str(tmp_path / "x.doc"))


def test_arff(spark, tmp_path):
    text = "% note\n@relation r\n@attribute 'my a' numeric\n@attribute b {1,-1}\n@attribute Result {1,-1}\n@data\n1, 'x y', -1\n% skip\n2,3\n"
    got = [tuple(r) for r in readers.read_arff(spark, put(tmp_path / "a.arff", text)).collect()]
    assert got == [("1", "x y", "-1"), ("2", "3", "")]


def test_lines_keep_physical_numbers(spark, tmp_path):
    got = readers.read_lines(spark, put(tmp_path / "f.txt", "# c\n\n http://a.b/c, \nhttps://x.y 2024-01-02T03:04\nnope\n")).orderBy("line_number").collect()
    assert [(r["line_number"], r["line"]) for r in got] == [(3, "http://a.b/c,"), (4, "https://x.y 2024-01-02T03:04"), (5, "nope")]
    feed = {r["url"]: r for r in adapters.adapter("openphish")(spark, str(tmp_path / "f.txt")).collect()}
    assert set(feed) == {"http://a.b/c", "https://x.y"}
    assert feed["https://x.y"]["timestamp"] == "2024-01-02T03:04" and feed["https://x.y"]["given_label"] == 1
    assert feed["https://x.y"]["metadata"] == {"raw_line": "https://x.y 2024-01-02T03:04"}


XML = """<output><entries><entry><url>http://a.b</url><phish_id>7</phish_id><details><detail><ip_address>1.2.3.4</ip_address></detail></details><submission><submission_time>t0</submission_time></submission><verification><verified>yes</verified><verification_time>t1</verification_time></verification><status><online>yes</online></status><target>Bank</target></entry>
<entry><url>http://c.d</url><phish_id>8</phish_id><submission><submission_time>t2</submission_time></submission><verification><verified>no</verified></verification></entry></entries></output>"""


def test_verified_feed(spark, tmp_path):
    got = {r["original_id"]: r for r in adapters.adapter("phishtank")(spark, put(tmp_path / "p.xml", XML)).collect()}
    assert (got["7"]["given_label"], got["7"]["timestamp"], got["7"]["metadata"]["target"]) == (1, "t1", "Bank")
    assert "1.2.3.4" in got["7"]["metadata"]["details"]
    assert (got["8"]["given_label"], got["8"]["timestamp"]) == (0, "t2")
    rows = adapters.adapter("phishtank")(spark, put(tmp_path / "online-valid.csv", "url,phish_id\nhttp://a.b,1\n,2\n")).collect()
    assert [(r["url"], r["given_label"]) for r in rows] == [("http://a.b", 1)]


def test_tabular_label_is_last_column_by_default(spark, tmp_path):
    rows = adapters.adapter("uci_phishing")(spark, put(tmp_path / "t.csv", "f1,f2,z\n1,NA,-1\n0,2,1\n5,6,0\n")).orderBy("original_id").collect()
    assert [(r["tabular"], r["given_label"]) for r in rows] == [({"f1": "1"}, 1), ({"f1": "0", "f2": "2"}, 0), ({"f1": "5", "f2": "6"}, None)]


def test_pages(spark, tmp_path):
    path = put(tmp_path / "train.jsonl", '{"URL": "http://a.b", "text": "<html>x</html>", "label": "Phish", "extra": "e"}\n{"URL": null, "text": null, "label": "0", "extra": null}\n')
    rows = adapters.adapter("phreshphish")(spark, path).collect()
    assert len(rows) == 1 and rows[0]["html"] == "<html>x</html>" and rows[0]["text"] is None
    assert rows[0]["given_label"] == 1 and rows[0]["split"] == "train" and rows[0]["metadata"] == {"extra": "e"}
    put(tmp_path / "raw/phishing/a.html", "<html>p</html>")
    put(tmp_path / "raw/phishing/a.url", "http://p.q\nmore")
    put(tmp_path / "raw/benign/b.txt", "hello")
    got = {r["original_id"]: r for r in adapters.adapter("mendeley")(spark, str(tmp_path / "raw")).collect()}
    assert (got["phishing/a.html"]["url"], got["phishing/a.html"]["given_label"]) == ("http://p.q", 1)
    assert (got["benign/b.txt"]["text"], got["benign/b.txt"]["given_label"]) == ("hello", 0)


def test_places_do_not_depend_on_splits(spark, tmp_path):
    lines = [f"http://a.b/{k}" if k % 7 else "" for k in range(2000)]
    put(tmp_path / "in/b/x.txt", "\n".join(lines))
    put(tmp_path / "in/b.c/y.csv", "url,id\n" + "\n".join(f"http://c.d/{k}," for k in range(50)))
    put(tmp_path / "in/a.jsonl", "\n".join(f'{{"url": "http://e.f/{k}"}}' for k in range(500)))
    spark.range(300).selectExpr("concat('http://g.h/', id) AS url").repartition(1).write.parquet(str(tmp_path / "in/p.parquet"))
    found = []
    for size in ("1000", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = adapters.load_sources(spark, {"openphish": str(tmp_path / "in")}).orderBy(*adapters.in_order()).collect()
        found.append([(r["original_id"], r["url"]) for r in rows])
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and len(found[0]) == sum(1 for x in lines if x) + 850
    want = [(f"a.jsonl:{k + 1}", f"http://e.f/{k}") for k in range(500)] + [(f"x.txt:{k + 1}", x) for k, x in enumerate(lines) if x] + [(f"y.csv:{k + 1}", f"http://c.d/{k}") for k in range(50)]
    assert found[0][: len(want)] == want  # "b" before "b.c", as folders, though "/" comes after "."
    assert [u for _, u in found[0][len(want) :]] == [f"http://g.h/{k}" for k in range(300)]


def test_arff_places(spark, tmp_path):
    text = "@relation r\n@attribute a numeric\n@attribute Result {1,-1}\n@data\n% skip\n1,1\n\n2,-1\n"
    rows = adapters.adapter("uci_phishing")(spark, put(tmp_path / "t.arff", text)).orderBy("row").collect()
    assert [(r["original_id"], r["tabular"], r["given_label"]) for r in rows] == [("t.arff:1", {"a": "1"}, 0), ("t.arff:2", {"a": "2"}, 1)]


def test_registry_and_readiness(spark, tmp_path):
    assert {"mendeley", "openphish", "oscar_aux", "phishtank", "phreshphish", "uci_phishing"} <= set(adapters.names())
    with pytest.raises(ValueError):
        adapters.register("openphish")(lambda s, p: None)
    with pytest.raises(KeyError):
        adapters.adapter("none")
    assert adapters.readiness(spark, "openphish", str(tmp_path / "missing.csv"))["status"] == "not_ready"
    texts = put(tmp_path / "o.txt", "un texte\nautre\n")
    assert adapters.readiness(spark, "oscar_aux", texts) == {"dataset": "oscar_aux", "status": "ready", "previewed": 2}
    both = adapters.load_sources(spark, {"oscar_aux": texts, "openphish": put(tmp_path / "u.txt", "http://a.b\n")}, {"oscar_aux": 1}).collect()
    assert sorted((r["source_rank"], r["source"]) for r in both) == [(0, "openphish"), (1, "oscar_aux")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", ["v1", "v2"], 1), ("b", ["v2"], 0)], "sample_id string, views array<string>, n int")
    assert sinks.write_views(df, str(tmp_path / "views"), ["v1", "v2"]) == {"v1": 1, "v2": 2}
    assert sinks.write_views(df.limit(0), str(tmp_path / "views"), ["v1", "v2"]) == {"v1": 1, "v2": 2}  # complete, so not written again
    sinks.write_document(spark, {"b": 1, "a": [1]}, str(tmp_path / "doc"))
    assert sinks.read_document(spark, str(tmp_path / "doc")) == {"a": [1], "b": 1}
    assert sinks.markdown_table([{"a": 0.5, "b": None}], ["a", "b"]).splitlines()[2] == "| 0.5000 |  |"
    sinks.write_comparison(df, str(tmp_path / "cmp"))
    assert spark.read.csv(str(tmp_path / "cmp"), header=True).count() == 2
