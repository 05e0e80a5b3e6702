"""The pipeline stage by stage against plain Python on a small corpus."""

from __future__ import annotations

import re

import corpus_pipeline
from panelspark.llm import mixing, queries
from tests.llm.test_operators import bag, low_words, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus() -> list[tuple]:
    out = []
    for i in range(120):
        text = prose(i, 70)
        if i % 10 == 1:
            text = " ".join(w + "&&&" for w in text.split())
        elif i % 10 == 2:
            text += " idiot, moron, scum"
        elif i % 10 == 3:
            text = prose(i - 3, 70) + " tail"
        elif i % 10 == 4:
            text += " " + prose(7777, 25)
        elif i % 10 == 5:
            text += " mail jo.07@mail1.example.com"
        out.append((i, text, "en", f"s{i % 3}", len(text)))
    return [*out, out[0], (500, None, None, None, None), (501, "", "en", "s0", 0)]


def test_stages(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(7777, 25))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 10 != 1), int(r[0] % 10 == 2)) for r in rows[:100]],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path)).cache()
        seen[name] = docs.collect()
        if name != "mix":
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    clean = {r[0] for r in rows[:120] if r[0] % 10 not in (1, 2)}
    assert {r.doc_id for r in seen["quality"]} - {500, 501} == clean
    kept = {r.doc_id for r in seen["near_duplicates"]}
    bags = {r.doc_id: bag(r.text) for r in seen["quality"]}
    for i in bags:
        twin = [j for j in bags if j < i and bags[i] and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values())]
        assert (i in kept) == (not twin)
    assert len(seen["near_duplicates"]) == len(kept)
    item = low_words(prose(7777, 25))
    windows = {tuple(item[s:s + 10]) for s in range(len(item) - 9)}
    for r in seen["near_duplicates"]:
        w = low_words(r.text)
        hit = any(tuple(w[s:s + 10]) in windows for s in range(len(w) - 9))
        assert hit != (r.doc_id in {x.doc_id for x in seen["decontamination"]})
    before = {r.doc_id: r for r in seen["decontamination"]}
    for r in seen["personal_data"]:
        assert ("@" in (r.text or "")) == (r.doc_id % 10 == 5 and r.doc_id < 120) and "jo.07@" not in (r.text or "")
        assert r.n_chars == (None if r.text is None else len(r.text)) and r.source == before[r.doc_id].source
    sizes = {r.doc_id: len(re.findall("[^\x20\x09-\x0D]+", r.text or "")) for r in seen["personal_data"]}
    assert {r.doc_id: r.size for r in seen["mix"]} == sizes
    by_source = {s: sum(sizes[r.doc_id] for r in seen["personal_data"] if r.source == s) for s in ("s0", "s1", "s2")}
    assert {r.target for r in seen["mix"] if r.source} == set(mixing.targets([*by_source.values()], [1, 2, 3], 3))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(sizes)


def test_rows_that_share_an_identifier_are_told_apart(spark, tmp_path):
    leak, far, near = prose(7777, 25), prose(900, 70), prose(901, 70)
    rows = [(None, far, "en", "s0", 1), (None, prose(902, 70), "en", "s0", 2), (None, f"{prose(903, 40)} {leak}", "en", "s1", 3),
            (5, near, "en", "s0", 4), (7, near + " tail", "en", "s0", 5), (7, prose(904, 70), "en", "s1", 6), (7, far, None, "s0", 7),
            (8, prose(905, 70), "en", "s0", 8), (8, prose(905, 70), "en", "s0", 8), (None, None, None, None, 9), (None, "", "en", "s0", 10)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3).cache()
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).cache()
    assert sorted(r.n_chars for r in kept.collect()) == [1, 2, 3, 4, 6, 8, 9, 10]
    clean = corpus_pipeline.decontamination(spark, kept, str(tmp_path))
    assert sorted(r.n_chars for r in clean.collect()) == [1, 2, 4, 6, 8, 9, 10] and clean.columns == docs.columns


def test_queries_are_registered():
    names = {re.match(r"(op\d+_|pipeline)", n)[0] for n in queries.QUERIES}
    assert names == {"pipeline", *(f"op{n}_" for n in range(1, 14))}


def written(spark, path, rows, schema=COLUMNS, bench=(), labels=()):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(bench), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_empty_tables(spark, tmp_path):
    docs = written(spark, tmp_path, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.collect() == [] and (name == "mix" or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_clashing_columns_come_back_unchanged(spark, tmp_path):
    extra = ("row_digest", "pii_kinds", "kept", "junk_score", "abuse_score", "key", "w", "comp", "node", "given_0", "row")
    rows = [(i, prose(i, 60) + " mail jo.07@mail1.example.com", "en", "s0", 1, *(f"{c}{i}" for c in extra)) for i in range(30)]
    docs = written(spark, tmp_path, rows, ", ".join([COLUMNS, *(f"{c} string" for c in extra)]), labels=[(i, 1, 0) for i in range(20)])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        got = out.collect()
        assert out.columns == docs.columns and len(got) == 30, name
        assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in extra), name
    assert len(corpus_pipeline.mix(spark, docs, str(tmp_path)).collect()) == 30


def test_nulls_ties_and_no_benchmark(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (2, prose(1, 50), "en", None, 1), (2, prose(1, 50), "en", None, 1), (3, " \n", "en", "s", 2)]
    docs = written(spark, tmp_path, rows)
    clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert sorted(map(str, clean.collect())) == sorted(map(str, docs.collect()))
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "None"]
    masked = corpus_pipeline.personal_data(spark, docs, str(tmp_path)).collect()
    assert len(masked) == 5 and [r.text for r in masked if r.doc_id is None] == [None]
