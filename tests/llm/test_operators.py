"""Every corpus operator against a brute-force version on awkward rows, and on empty tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import (
    chat,
    decontaminate,
    language,
    mixing,
    near_dedup,
    pii,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    tokens,
    weak_labels,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, blob string, range string"
WORD = re.compile("[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéß") for _ in range(r.randint(2, 7))) for _ in range(n))


def texts() -> list[str | None]:
    base, passage, long = prose(1, 120), prose(2, 60), prose(3, 15_000)
    near = base.split()
    near[40] = "changed"
    return [base, base, " ".join(near), base.upper(), f"{prose(4, 50)} {passage} {prose(5, 50)}", f"{passage} {prose(6, 80)}",
            long, None, "", " \t\n ", "one", "one two", "la " * 400, f"{prose(7, 90)}\n{prose(7, 90)}", "ä" * 300,
            "x y " * 30, passage[:210], "null", prose(8, 19), prose(8, 20)]


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    out = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", None, "S3")[i % 4], None, "k", "b", "r") for i, t in enumerate(texts())]
    return out + [out[4], out[10]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def distinct(rows) -> list[tuple[int, str | None]]:
    return sorted({(r[0], r[1]) for r in rows}, key=lambda r: r[0])


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_substring_dedup(docs, rows, empty):
    got = {r.doc_id: r for r in substring_dedup.remove_repeated_windows(docs, windows_per_range=500).collect()}
    seen, cut = set(), 0
    for i, text in distinct(rows):
        words = (text or "").encode().split()
        mask = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s:s + 20])
            if window in seen:
                mask[s:s + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(w for w, m in zip(words, mask, strict=True) if not m)
        cut += sum(mask)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(words), sum(mask), sha(kept)), i
        assert got[i].kept_text.encode() == kept and sum(
            b - a for a, b in zip(got[i].span_starts, got[i].span_ends, strict=True)) == sum(mask)
    assert cut > 400 and substring_dedup.remove_repeated_windows(docs).count() == len(rows)
    assert substring_dedup.remove_repeated_windows(empty).collect() == []


@pytest.mark.parametrize("depth,gram", [(200, 64), (50, 16), (8, 8)])
def test_suffix_dedup(docs, rows, empty, depth, gram):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeated_bytes(docs, depth=depth, gram=gram, records_per_range=100).collect()}
    count = Counter()
    for _, text, *_ in rows:  # a repeated row is one more place
        data = (text or "").encode()
        count.update(data[s:s + depth] for s in range(len(data) - depth + 1))
    for i, text in distinct(rows):
        data = (text or "").encode()
        mask = bytearray(len(data))
        for s in range(len(data) - depth + 1):
            if count[data[s:s + depth]] > 1:
                mask[s:s + depth] = b"\1" * depth
        kept = bytes(b for b, m in zip(data, mask, strict=True) if not m)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(data), sum(mask), len(re.findall(b"\1+", bytes(mask))), sha(kept)), i
    assert suffix_dedup.remove_repeated_bytes(empty).collect() == []


def test_dedup_tells_rows_of_one_identifier_apart(spark):
    passage, other = prose(40, 60), prose(41, 300)
    rows = [(1, f"{prose(42, 100)} {passage}"), (None, f"{prose(43, 100)} {passage} {prose(44, 50)}"), (None, other),
            (7, f"{prose(45, 30)} {passage}"), (7, prose(46, 300)), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    got = {(r.doc_id, r.n_words): r for r in substring_dedup.remove_repeated_windows(docs, windows_per_range=50).collect()}
    assert {k: r.n_removed for k, r in got.items()} == {(1, 160): 60, (None, 210): 0, (None, 300): 0, (7, 90): 60, (7, 300): 0, (None, 0): 0}
    left = suffix_dedup.remove_repeated_bytes(docs, records_per_range=100).collect()
    size = len(passage.encode())
    assert len(left) == len(rows) and sorted(r.n_removed // size for r in left) == [0] * 4 + [1] * 3
    assert {bytes(r.kept_bytes).decode() for r in left if not r.n_removed} == {other, rows[4][1], ""}


def low_words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def test_decontaminate(spark, docs, rows, empty):
    items = [(1, texts()[4][100:500]), (2, "ONE two"), (3, None), (4, ""), (5, prose(9, 30)), (10, texts()[4][100:500]), (10, "la la la"),
             (None, "one")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, key string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    windows = defaultdict(set)
    for item, text in items:
        w = low_words(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s:s + 10])].add("" if item is None else str(item))
    for i, text in distinct(rows):
        w, found, mask = low_words(text), set(), set()
        for k, ids in windows.items():
            for s in range(len(w) - len(k) + 1):
                if tuple(w[s:s + len(k)]) == k:
                    mask.update(range(s, s + len(k)))
                    found |= ids
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            len(w), len(mask), len(found), sha(",".join(sorted(found))), bool(mask)), i
    assert not any(r.contaminated for r in decontaminate.contamination(docs, bench.limit(0)).collect())
    assert decontaminate.contamination(empty, bench).collect() == []


def overlaps(rows, items, width=10):
    """Per row: words, words hit, items hit; by comparing every window."""
    windows = defaultdict(set)
    for item, text in items:
        w = low_words(text)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[s:s + width])].add("" if item is None else str(item))
    sizes = {len(k) for k in windows}
    for text in rows:
        w, found, mask = low_words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[s:s + n])):
                    mask.update(range(s, s + n))
                    found |= ids
        yield len(w), len(mask), len(found), sha(",".join(sorted(found)))


def found_in(frame):
    return sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in frame.collect())


def test_decontaminate_folds_capitals(spark):
    item = "the quick brown fox of nasa jumps over a lazy dog again today"
    docs = [item, item.capitalize(), item.upper(), item.title(), "Mcdonald I saw " + item, "XML " + item.upper() + " END",
            " ".join(w[:2] + w[2:].upper() for w in item.split()), item.replace(" ", ", "), "É" + item, item.swapcase() + "É"]
    rows = [(i % 3, t) for i, t in enumerate(docs)] + [(None, t) for t in docs] + [(None, docs[1])]
    bench = [(1, item.title()), (2, "QUICK brown")]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                      spark.createDataFrame(bench, "item_id long, text string"))
    assert found_in(got) == sorted(overlaps([t for _, t in rows], bench))
    assert sorted(r.doc_id is None for r in got.collect()) == sorted(i is None for i, _ in rows)


def test_decontaminate_whole_tables(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    expected = sorted(overlaps([r.text for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]))
    assert found_in(decontaminate.contamination(docs, bench)) == expected and any(e[1] for e in expected)


def test_decontaminate_folds_words_apart(spark):
    words = ["ΟΔΟΣ", "ΒΙΒΛΙΟ", "ΤΟΠΟΣ", "ΛΟΓΟΣ", "ΝΟΜΟΣ", "ΧΡΟΝΟΣ"] * 3
    docs = spark.createDataFrame([(1, ".".join(words))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert decontaminate.contamination(docs, bench).first().n_hit == len(words)


def bag(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return Counter(tuple(w[s:s + 5]) for s in range(max(1, len(w) - 4))) if w else Counter()


def test_near_dedup(spark, rows, empty):
    more = list(rows)
    base, r = prose(50, 200).split(), random.Random(3)
    for i in range(60):  # near copies that need not be near to each other
        w = list(base)
        for k in range(r.randint(1, 8)):
            w[r.randrange(len(w))] = f"e{i}x{k}"
        more.append((100 + i, " ".join(w), *more[0][2:]))
    got = {x.doc_id: x for x in near_dedup.near_duplicates(spark.createDataFrame(more, DOCS)).collect()}
    ids = distinct(more)
    bags, parent = {i: bag(t) for i, t in ids}, {i: i for i, _ in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, _ in ids:
        for j, _ in ids:
            if j < i and bags[i] and (common := sum((bags[i] & bags[j]).values())) >= 0.8 * sum((bags[i] | bags[j]).values()):
                assert common
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {i: got[i].class_id for i in parent} == {i: find(i) for i in parent}
    size = Counter(find(x[0]) for x in more)
    assert all(got[i].class_rows == size[find(i)] for i in parent if bags[i])
    assert near_dedup.near_duplicates(empty).collect() == []


def test_bagminhash_is_unbiased():
    a = (prose(1, 150) + " ") * 3
    b = a.split()
    b[200:260] = ["new"] * 60
    pair = [a.encode(), " ".join(b).encode()]
    points = near_dedup.signatures(*near_dedup.bags(pair), 2, 4000)
    assert abs((points[0] == points[1]).mean() - near_dedup.overlap(pair[:1], pair[1:])[0]) < 0.03


def test_cells_find_all_components():
    words = [prose(70, 100)] * 6 + [prose(71, 100)] * 3
    data = [f"{w} {prose(80 + i, 3)}".encode() for i, w in enumerate(words)]
    links = near_dedup.cell_links(np.arange(9), np.arange(9), np.zeros(9, int), data, 0.8)
    assert len(links) == 7 and {min(x) < 6 and max(x) < 6 or min(x) >= 6 for x in links} == {True}
    across = near_dedup.cell_links(np.arange(9), np.arange(9), np.arange(9) % 2, data, 0.8)
    assert all(a % 2 != b % 2 for a, b in across)


def test_mixing(docs, rows, empty):
    got = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = Counter()
    for _, text, _, source, *_ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([sizes[s] for s in order], [1, 2, 3, 1], 3), strict=True))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == goal[r.source] and r.taken == r.size * r.repeats <= 3 * r.size
        taken[r.source] += r.taken
    assert abs(sum(goal.values()) - sum(sizes.values())) < 1e-6
    assert all(goal[s] - taken[s] <= max(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in goal)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) if None not in order else Counter(map(str, got)) == Counter(map(str, again))
    assert mixing.mix(empty).collect() == []


def test_targets_stop_and_reshare():
    assert mixing.targets([10, 1000, 0], [3, 1, 1], 3) == [30.0, 980.0, 0.0]


def best_sum(sizes, counts, budget) -> int:
    reach = {0}
    for size, n in zip(sizes, counts, strict=True):
        reach = {r + k * int(size) for r in reach for k in range(int(n) + 1) if r + k * int(size) <= budget}
    return max(reach)


@pytest.mark.parametrize("seed", range(60))
def test_fit_counts_reaches_the_best_sum(seed):
    r = random.Random(seed)
    most = (12, 60, 3000, 120_000)[seed % 4]
    sizes = np.array(sorted(r.sample(range(1, most + 1), r.randint(1, 5))))
    counts = np.array([r.randint(1, 4) for _ in sizes])
    budget = r.randint(0, int((sizes * counts).sum()))
    took = mixing.fit_counts(sizes, counts, budget)
    assert (took >= 0).all() and (took <= counts).all() and (sizes * took).sum() == best_sum(sizes, counts, budget)


@pytest.mark.parametrize("sizes,counts,budget,best", [
    ([80_000, 90_000, 100_000], [1, 1, 1], 170_000, 170_000), ([20_000, 30_000], [3, 3], 110_000, 110_000),
    ([80_001, 90_001, 100_003], [1, 1, 1], 170_002, 170_002), ([7, 10], [1, 1_000_000_000], 9_999_999_995, 9_999_999_990),
    ([7, 10], [3, 1_000_000_000], 5_000_000_001, 5_000_000_001), ([70_001, 70_003], [4, 4], 350_011, 350_011)])
def test_fit_counts_gives_back(sizes, counts, budget, best):
    sizes, counts = np.array(sizes), np.array(counts)
    took = mixing.fit_counts(sizes, counts, budget)
    assert (took >= 0).all() and (took <= counts).all() and (sizes * took).sum() == best


def test_chat(spark, empty):
    turns = [(1, 1, "assistant", "a [b] <c> \\d\\\\ </s>\n<s>[user]\n"), (1, 0, "user", "hi"), (2, 0, None, None), (2, 1, "assistant", ""),
             (None, 0, "user", "é"), (3, None, "we]ird\n", "x"), (3, 2, "assistant", "ß</s>"), (3, 2, "assistant", "ß</s>"),
             *[(9, i, ("user", "assistant")[i % 2], prose(i, 3000)) for i in range(150)]]
    frame = spark.createDataFrame([(*t, "k") for t in turns], "conv_id long, turn long, role string, text string, key string")
    formatted = chat.format_turns(frame).cache()
    assert formatted.where("conv_id = 9").count() > 1
    want = {}
    for conv in {t[0] for t in turns}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        loss = "".join(t[3] for t in own if t[2] == "assistant")
        chars = sum(len(chat.escape(t[2].encode()).decode()) + len(chat.escape(t[3].encode()).decode()) + 11 for t in own)
        want[conv] = (conv, len(own), sha("".join(f"{t[2]}\n{t[3]}\n" for t in own)), len(loss), sha(loss), chars)
    for stored in (False, True):
        assert {r.conv_id: tuple(r) for r in chat.read_back(formatted, stored=stored).collect()} == want
    assert chat.format_turns(frame.limit(0)).collect() == []


def test_language(docs, spark, rows, empty):
    extra = [(1000 + 2 * i + (lang == "xx"), " ".join(random.Random(i).choices(words.split(), k=60)), lang, "s", None, "k", "b", "r")
             for i in range(120) for lang, words in (("en", "the of and house river with from that"), ("xx", "zorp qwel mnub vrakt yil"))]
    frame = docs.drop("key").unionByName(spark.createDataFrame(extra, DOCS).drop("key"))
    got = language.identify(frame, F.col("doc_id") < 1150).collect()
    known = {r[0]: r[2] for r in extra}
    held = [r for r in got if r.doc_id >= 1150]
    assert len(got) == len(rows) + len(extra) and all(r.lang_pred == known[r.doc_id] for r in held if known[r.doc_id] == "xx")
    assert {r.lang_pred for r in got if r.doc_id in (7, 8, 9)} == {"und"} and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in language.identify(docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(empty).collect() == []


def test_quality_rules(docs, rows, empty):
    got = {r.doc_id: r for r in quality_rules.quality(docs).collect()}
    for i, text in distinct(rows):
        text = text or ""
        words = WORD.findall(text)
        seen = Counter(tuple(words[s:s + 5]) for s in range(len(words) - 4))
        repeated = {k for s in range(len(words) - 4) if seen[tuple(words[s:s + 5])] > 1 for k in range(s, s + 5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed), i
        assert not (failed and r.kept)
    p, q = np.array([0.5, 0.5, 0]), np.array([0, 0, 1.0])
    assert quality_rules.divergence(p, q) == pytest.approx(1) and quality_rules.divergence(p, p) == 0
    assert quality_rules.quality(empty).collect() == []


def test_quality_references_count_every_word(docs, rows):
    ref = quality_rules.references(docs, common=10_000).collect()
    for lang in ("en", "de"):
        words = Counter(w for r in rows if r[2] == lang for w in re.sub(
            "[A-Z]", lambda m: m[0].lower(), r[1] or "").encode().split())
        codes = {int(tokens.words([w])[0][0].view(np.int64)): n for w, n in words.items()}
        assert {r.code: r.n for r in ref if r.lang == lang and r.kind == 1} == codes
        assert [r.n for r in ref if r.lang == lang and r.kind == 2] == [sum(words.values())]


KEY = hashlib.blake2b(b"k").digest()[:32]


def test_many_languages(spark):
    """More languages than sample rows, and than any fixed number of references."""
    r = random.Random(8)
    def text(k):
        return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz"[k % 13:k % 13 + 6]) for _ in range(5)) + str(k) * 3 for _ in range(60))
    rows = [(k, text(k), f"lang{k}", None, None, "k", "b", "r") for k in range(300)]
    frame = spark.createDataFrame(rows, DOCS)
    said = {x.doc_id: x.lang_pred for x in language.identify(frame, sample_rows=100).collect()}
    assert sum(said[k] == f"lang{k}" for k in range(300)) > 270
    many = spark.createDataFrame([(k, f"word{k} of {'x ' * 8}" * (30 if k < 3 else 1), f"lang{k}", None, None, "k", "b", "r") for k in range(2100)], DOCS)
    got = quality_rules.quality(many).collect()
    assert len(got) == 2100 and all(x.word_distance < 1e-6 for x in got)


def test_quality_verdict(spark):
    """Distances to the nearest reference, word by word, and the verdict that follows."""
    r = random.Random(4)
    common = {"en": ["the", "of", "and", "to", "in"], "de": ["der", "und", "die", "zu", "das"]}
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        n = (9, 40, 300)[i % 3]
        words = [r.choice(common[lang]) if r.random() < 0.5 else f"w{r.randint(0, 400)}" for _ in range(n)]
        if i % 10 == 7:
            words = [f"Z{k}%" for k in range(n)]
        rows.append((i, " ".join(words), lang, None, None, "k", "b", "r"))
    got = {x.doc_id: x for x in quality_rules.quality(spark.createDataFrame(rows, DOCS), common=5).collect()}
    def folded(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t).split()
    def classes(t):
        return Counter("lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "space" if c.isspace() else "symbol" for c in t)
    def distance(p, q):
        keys = {*p, *q}
        m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in keys}
        return max(0.0, sum(x.get(k, 0) * np.log2(x[k] / m[k]) for x in (p, q) for k in keys if x.get(k)) / 2) ** 0.5
    def share(c):
        return {k: v / sum(c.values()) for k, v in c.items()}
    words = {lang: Counter(w for _, t, x, *_ in rows if x == lang for w in folded(t)) for lang in common}
    chars = {lang: sum((classes(t) for _, t, x, *_ in rows if x == lang), Counter()) for lang in common}
    top = {lang: {w for w, _ in c.most_common(5)} for lang, c in words.items()}
    union = set().union(*top.values())
    for i, t, *_ in rows:
        w = Counter(x if x in union else "" for x in folded(t))
        word = min(distance(share(w), share(Counter({**{x: words[lang][x] for x in top[lang]},
                                                     "": sum(words[lang].values()) - sum(words[lang][x] for x in top[lang])}))) for lang in common)
        char = min(distance(share(classes(t)), share(chars[lang])) for lang in common)
        assert got[i].word_distance == pytest.approx(word, abs=1e-9) and got[i].char_distance == pytest.approx(char, abs=1e-9)
        far = (len(folded(t)) >= 50 and word > 0.3 + 1.3 / len(folded(t)) ** 0.5) or (len(t) >= 300 and char > 0.28)
        assert got[i].kept == (not got[i].base_failed and not far)


@pytest.mark.parametrize("value,kind", [
    ("4111111111111111", "card"), ("4111 1111 1111 1111", "card"), ("1234567890123456", "account"), ("+1 (017) 555-7713", "phone"),
    ("192.168.7.23", "ip"), ("123-45-6789", "ssn"), ("2024-02-29", "date"), ("29.02.2024", "date"), ("12/31/1999", "date"),
    ("31/12/1999", "date"), ("jo.07@mail1.example.com", "email"), ('token = "9c8b45435718dcc700c184aa"', "secret")])
def test_pii_values_move_within_their_format(value, kind):
    new, kinds = pii.pseudonymise(f"see {value}!!", KEY)
    assert kinds == [kind] and value not in new and pii.pseudonymise(new, KEY, back=True)[0] == f"see {value}!!"
    assert pii.pseudonymise(f"again {value}", KEY)[0][6:] == new[4:-2]
    if kind not in ("date", "ssn"):
        assert re.sub(r"\d", "9", re.sub("[a-z]", "a", new)) == re.sub(r"\d", "9", re.sub("[a-z]", "a", f"see {value}!!")) or kind == "secret"
    if kind == "card":
        assert pii._luhn(re.sub(r"\D", "", new)) % 10 == 0


@pytest.mark.parametrize("text", ["999.1.1.1", "2023-02-30", "000-12-3456", "1.2.3", "3.14159", "x = 12", "12:30 or 7-8", "a@b", ""])
def test_pii_leaves_other_text_alone(text):
    assert pii.pseudonymise(text, KEY) == (text, [])


@pytest.mark.parametrize("domain", [2, 3, 10, 97, 256])
def test_pseudonyms_are_permutations_without_fixed_points(domain):
    moved = [pii.pseudonym(x, domain, KEY, "t") for x in range(domain)]
    assert sorted(moved) == list(range(domain)) and all(x != y for x, y in enumerate(moved))
    assert [pii.pseudonym(y, domain, KEY, "t", back=True) for y in moved] == list(range(domain))


def test_pii_rows(docs, rows, spark, empty):
    extra = spark.createDataFrame([(900, "call +1 (017) 555-7713 or 10.0.0.7", "en", "s", 3, "k", "b", "r")] * 2, DOCS)
    got = pii.mask(docs.unionByName(extra), "k").collect()
    before = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows) + 2 and all(r.text == before[r.doc_id] for r in got if r.doc_id != 900)
    assert len({r.text for r in got if r.doc_id == 900}) == 1 and [r.pii_kinds for r in got if r.doc_id == 900][0] == ["phone", "ip"]
    assert pii.mask(empty, "k").collect() == [] and pii.mask(docs, "k").columns == [*docs.columns, "pii_kinds"]


def test_pii_key_is_required_and_comes_from_the_session(docs, spark):
    with pytest.raises(TypeError):
        pii.mask(docs)
    with pytest.raises(ValueError):
        pii.mask(docs, "")
    with pytest.warns(UserWarning):
        assert pii.session_key(spark) == pii.DEMONSTRATION_KEY
    spark.conf.set(pii.KEY_SETTING, "mine")
    try:
        assert pii.session_key(spark) == "mine"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


PIECES = ["123-456-7890", "@", "example.com", "=", "id=", ": ", "4111111111111111", "abcdef", "ABCDEF0123456789ABCD", "4111 1111 1111 1111",
          "a1b2c3d4e5f6a1b2c3d4", "10.0.0.7", "1/2/2024", "31/12/1999", "2024-02-29", "9.9.1950", "123-45-6789", "+1 (017) 555-7713", " ", ".", "-",
          "jo.07@mail1.example.com", "é", "x9@a.bc", "\uff11", "\u0661", "_", "'", "12345678901234567890", "\n"]


def test_pii_can_be_undone_over_all_neighbours():
    """Every pair of pieces, and long seeded chains of them: what comes back is the given text."""
    rng = np.random.default_rng(7)
    texts = [a + b for a in PIECES for b in PIECES] + ["".join(rng.choice(PIECES, rng.integers(3, 12))) for _ in range(3000)]
    moved = 0
    for text in texts:
        new, kinds = pii.pseudonymise(text, KEY)
        assert len(new) == len(text) and pii.pseudonymise(new, KEY, back=True) == (text, kinds)
        moved += bool(kinds)
        assert (new != text) == bool(kinds)
    assert moved > 2000


@pytest.mark.parametrize("text", ["41111111\uff111111111", "2024-02-2\uff19", "\u0661\u0662\u0663-45-6789", "+\uff11 (\uff10\uff1017) 555-77"])
def test_pii_digits_are_ascii(text):
    assert pii.pseudonymise(text, KEY) == (text, [])


def test_pii_short_dates_keep_their_length():
    new = {pii.pseudonymise(f"{m}/{d}/2024", KEY)[0] for m in range(1, 10) for d in range(1, 10)}
    assert len(new) == 81 and all(re.fullmatch(r"[1-9]/[1-9]/(19|20)\d\d", x) for x in new)


def test_label_model_recovers_accuracies():
    r = np.random.default_rng(5)
    truth = r.random(20_000) < 0.2
    right = np.array([0.95, 0.9, 0.85, 0.97])
    votes = np.where(r.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[r.random((20_000, 4)) < 0.3] = weak_labels.NONE
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak_labels.fit_label_model(patterns, counts, trusted=0.97)
    said = model.chance[:, :, :2] / model.chance[:, :, :2].sum(axis=2, keepdims=True)
    assert abs(model.prior - 0.2) < 0.02 and np.abs(said[0, :, 0] - right).max() < 0.03 and np.abs(said[1, :, 1] - right).max() < 0.05


def test_classifier(spark, empty):
    rows, labels = [], []
    for i in range(400):
        kind = ("fine", "junk", "abuse", "fine")[i % 4]
        text = prose(i, 80)
        text = " ".join(w + "$$$" for w in text.split()) if kind == "junk" else text + " you idiot, moron and scum" if kind == "abuse" else text
        rows.append((i, text, "en", "s", None, "k", "b", "r"))
        if i % 3 == 0:
            labels.append((i, int(kind != "junk"), int(kind == "abuse"), "x"))
    rows += [(1000, None, "en", "s", None, "k", "b", "r"), (1001, "", "en", "s", None, "k", "b", "r")]
    docs = spark.createDataFrame(rows, DOCS)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    model = weak_labels.fit(docs, given)
    got = {r.doc_id: r for r in weak_labels.score(docs, model).collect()}
    assert len(got) == 402 and all(got[i].kept == (i % 4 in (0, 3)) for i in range(400))
    assert got[1000].junk_score == got[1001].junk_score
    assert all(weak_labels.score(docs, weak_labels.fit(docs, given)).select("kept").collect()[0])
    unlabelled = weak_labels.fit(docs, given.limit(0))
    assert sum(r.kept == (r.doc_id % 4 in (0, 3)) for r in weak_labels.score(docs, unlabelled).where("doc_id < 400").collect()) > 380
    assert weak_labels.score(empty, weak_labels.fit(empty, given)).collect() == []
