"""Normal forms of times against Python's own reading of them."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from lakemill.functions.times import normalized_time


def plain(text):
    text = (text or "").strip()
    if not text:
        return None
    try:
        return datetime.fromisoformat(text.replace("Z", "+00:00")).isoformat()
    except ValueError:
        return text


def forms(rng):
    y, m, d = rng.randint(1, 9990), rng.randint(0, 13), rng.randint(0, 31)
    w = rng.choice([rng.randint(0, 54), rng.randint(52, 53)])
    date = rng.choice([f"{y:04}-{m:02}-{d:02}", f"{y:04}{m:02}{d:02}", f"{y:04}-W{w:02}-{rng.randint(0, 8)}", f"{y:04}-W{w:02}", f"{y:04}W{w:02}{rng.randint(1, 7)}", f"2024-02-{rng.randint(28, 30)}"])
    h, n, s = rng.randint(0, 24) % 25, rng.choice([0, 7, 59, 60]), rng.choice([0, 9, 59, 60])
    if h == 24:
        h = 25
    clock = rng.choice([f"{h:02}", f"{h:02}:{n:02}", f"{h:02}:{n:02}:{s:02}", f"{h:02}{n:02}", f"{h:02}{n:02}{s:02}", f"{h:02}:{n:02}{s:02}"])
    if clock.count(":") == 2 or (len(clock) == 6 and ":" not in clock):
        clock += rng.choice(["", "", f".{rng.randint(0, 999):03}", f",{rng.randint(0, 10**9)}", ".000"])
    zone = rng.choice(["", "", "Z", "+05:30", "-0000", "-00:30", "+23", "+24:00", "+01:02:03", "-010203.5", "+5"])
    return rng.choice([date, date + rng.choice(["T", " ", "t", "_"]) + clock + zone, date + "T" + clock + zone, " " + date + "\n"])


def test_as_python_reads_them(spark):
    rng = random.Random(12)
    texts = [forms(rng) for _ in range(4000)] + [None, "", "  ", "soon", "2024", "2024-1-1", "2024-01-01T", "Z", "2024-01-01T10:00Zulu", "0000-01-01", "2020-W53-7", "2021-W53-1", "٢٠٢٤-01-01", "2024-01-01T10:00:00.1234567+00:00"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", normalized_time(F.col("t")).alias("n")).orderBy("i").collect()
    wrong = [(texts[r["i"]], r["n"], plain(texts[r["i"]])) for r in rows if r["n"] != plain(texts[r["i"]])]
    assert not wrong, (len(wrong), wrong[:10])
