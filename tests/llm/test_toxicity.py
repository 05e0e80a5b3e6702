"""Toxicity: scores against a word-by-word version, held-out accuracy, misspellings, awkward rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from panelspark.llm import queries, tokens, toxicity

DOCS = "doc_id long, text string, lang string, score string, key string"
BAD = ("blockhead", "dunderpate", "scoundrel")


def prose(r, n, extra=()):
    words = ["".join(r.choice(("ti", "on", "re", "an", "he", "bo", "sel")) for _ in range(r.randint(1, 4))) for _ in range(n)]
    for w in extra:
        words[r.randrange(n)] = w
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    return [(i, prose(r, r.choice([20, 60, 400, 3000]), [r.choice(BAD) + r.choice(("", ".", "!")) for _ in range(2)] if i % 5 == 0 else ()))
            for i in range(400)]


@pytest.fixture(scope="module")
def model(spark, rows):
    docs = spark.createDataFrame([(*r, "en", "s", "k") for r in rows], DOCS).repartition(5)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


def test_held_out_and_misspelled(model, rows):
    unseen = [t.encode() for i, t in rows if i >= 300]
    assert [bool(p >= 0.7) for p in model.score(unseen)[0]] == [i % 5 == 0 for i in range(300, 400)]
    clean = "tionre anhe bo selbo reti on heanre tionon an "
    for word in ("blokhead", "Blockheadd", "dunderpat3", "SCOUNDREL", "scoundrels"):
        assert model.score([f"{clean}{word} {clean}".encode()])[0][0] > 0.5 > model.score([(clean * 2).encode()])[0][0]


def test_scores_word_by_word(model):
    """The most toxic passage of each text, from n-grams that are cut one at a time."""
    def worth(word):
        marked = b" " + word + b" "
        grams = [marked[i:i + n] for n in toxicity.GRAMS for i in range(len(marked) - n + 1)]
        def bucket(gram):
            codes = tokens.byte_codes(np.frombuffer(gram, np.uint8))
            return int(tokens.span_hash(tokens.prefix_hash(codes), np.array([0]), np.array([len(codes)]))[0]) & (len(model.weight) - 1)
        return sum(float(model.weight[bucket(g)]) for g in [word, *grams]) / (1 + len(grams))
    r = random.Random(9)
    texts = [prose(r, n, BAD[:n % 4]).encode() for n in (1, 5, 6, 7, 12, 13, 50)] + [b"", b" \n", "Öß, idiot. é".encode(), b"a"]
    got, at, size = model.score(texts)
    for i, text in enumerate(texts):
        words = text.translate(toxicity._FOLD).split()
        k = -(-len(words) // toxicity.PASSAGE)
        parts = [[worth(w) for j, w in enumerate(words) if j * k // len(words) == p] for p in range(k)]
        logit = max((sum(p) / len(p) for p in parts), default=0.0) + model.bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)
        assert (size[i] > 0) == bool(words) and at[i] + size[i] <= len(words)


def test_awkward_rows(spark, model):
    texts = [None, "", " \t", "one", "blockhead " * 40_000, "x" * 200_000, "ti on", "ti on", "퟿ é"]
    rows = [(i if i else None, t, "en", "s", "k") for i, t in enumerate(texts)] * 2
    got = {}
    for r in toxicity.score(spark.createDataFrame(rows, DOCS), model).collect():
        got.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(v) == 1 for v in got.values()) and got[None] == got[1] == got[2] and got[6] == got[7]
    assert got[4].pop() > 0.7 and all(0 <= s <= 1 for v in got.values() for s in v)


def test_without_labels_or_rows(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.fit(none, labels)).collect() == []
    one = spark.createDataFrame([(1, "a b", "", "", "")], DOCS)
    assert toxicity.score(one, toxicity.fit(one, labels)).first().score < 0.5
    assert toxicity.score(one, toxicity.fit(one, labels.limit(0))).first().score == 0.5


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op11_toxicity(spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    marks = [(r.toxic, got[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert np.mean([p for t, p in marks if t]) > 0.75 and np.mean([p for t, p in marks if not t]) < 0.03
