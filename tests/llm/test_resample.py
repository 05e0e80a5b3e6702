"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from panelspark.llm import queries, resample

DOCS = "doc_id long, text string, rank string, score string, bucket long, _part long"


def features(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, Counter(zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1))


def expected(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s += features(text)[1]
    for text in target:
        t += features(text)[1]
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(gain[b] * n for b, n in f.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able[:5 * len(able) // 100])}
    return sorted((r[0], *r[1:4], rank.get(id(r))) for r in rows if r[0] is not None), sum(r[4] for r in rows)


def listed(frame):
    return sorted((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect() if r.doc_id is not None)


def awkward():
    r = random.Random(3)
    def word():
        return "".join(r.choice("abABcDéΣσß'-7 ") for _ in range(r.choice([1, 2, 3, 6, 70])))
    texts = [" ".join(word() for _ in range(r.randint(15, 60))) for _ in range(300)]
    rows = list(enumerate([*texts, None, "", " .. ", "one", "one two", "a" * 300 + " b " + "c" * 65, "x y " * 40_000]))
    return [*rows, *rows[:20], (None, texts[3]), (None, texts[4]), (None, None), (5, texts[9])]


def test_against_plain_python(spark):
    docs, target = awkward(), [awkward()[3][1], None, "", "the end of b c"]
    frame = spark.createDataFrame([(*d, "r", "s", 1, 2) for d in docs], DOCS).repartition(7)
    got = resample.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    want, able = expected(docs, target)
    assert listed(got) == want
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 5 * able // 100 + 1))


def test_equal_rows_are_ranked_apart(spark):
    frame = spark.createDataFrame([(None, "b c " * 20)] * 1000, "doc_id long, text string")
    drawn = resample.resample(frame, frame.limit(0)).where("rank is not null").collect()
    assert sorted(r["rank"] for r in drawn) == list(range(1, 51))


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert resample.resample(none, none).collect() == []


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.op13_importance_resampling(spark, sf)
    assert listed(got) == expected(docs, target)[0] and got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
