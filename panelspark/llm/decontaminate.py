"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every benchmark window is a set of word shingles at fixed offsets. Shingles are ordered by rarity in
the corpus, and since containment must be whole, one prefix token is necessary: the rarest shingle
of the window. Documents meet windows on that token only; positional and length bounds drop starts
that cannot hold the window, and the words themselves are compared at the end.

Scale: documents are exploded to 64-bit shingle hashes and meet the benchmark's shingles, which are
broadcast only when counted below ``broadcast_rows``; only matching rows are written and used
further. Rarity is one pre-aggregated count. The documents' words move once, for verification.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tables
from panelspark.runtime import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose letters A-Z, and no others, were folded; null has none."""
    # lower() folds just A-Z where the text is ASCII, and is much faster than translate()
    ascii_only = F.octet_length(text) == F.char_length(text)
    folded = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _shingles(words: str, k: int) -> Column:
    """Hashes of all runs of ``k`` words."""
    return F.expr(f"if(size({words}) >= {k}, transform(sequence(1, size({words}) - {k - 1}), "
                  f"i -> xxhash64(slice({words}, i, {k}))), array())")


def _windows(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Distinct windows: their words, how many, and the items (as sorted strings) that hold them."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                             _words(F.col(text).cast("string")).alias("w")).where(F.size("w") > 0)
    cut = items.select("item", F.explode(F.expr(
        f"transform(sequence(1, greatest(size(w) - {width - 1}, 1)), i -> slice(w, i, {width}))")).alias("win"))
    return cut.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        F.md5(F.array_join("win", " ").cast("binary")).alias("wid"), "win", "items", F.size("win").alias("len"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = 10, shingle: int = 5,
                  broadcast_rows: int = 2_000_000) -> DataFrame:
    """Per row of ``docs``: which of its words lie in benchmark windows, and of which items.

    A window is ``width`` consecutive words of an item; an item with fewer words, but not none, is
    one window. Returns ``doc_id``, ``n_words``, ``n_hit`` (words inside any occurrence), ``n_items``
    and ``items_sha256`` (items with occurring windows), ``contaminated`` and ``hits`` (occurrences
    as structs of ``start`` and ``len`` in words).

    Null and empty texts have no words and hit nothing. Rows that share a ``doc_id`` are judged each
    by its own words. A repeated ``item_id`` counts once, a null one as an empty string. With no
    benchmark window every document is clean. Other columns are ignored.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # the identifier travels behind a digest of the row, so that rows of one identifier do not gather under one key
    key = F.concat_ws("|", F.md5(F.coalesce("text", F.lit("")).cast("binary")), F.col("doc_id").cast("string"))
    per_row = judged(given.select(key.alias("key"), "text"), benchmark, item_id, item_text, width, shingle, broadcast_rows)
    return per_row.select(F.try_element_at(F.split("key", r"\|"), F.lit(2)).cast("long").alias("doc_id"), *per_row.columns[1:])


def judged(rows: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", width: int = 10,
           shingle: int = 5, broadcast_rows: int = 2_000_000) -> DataFrame:
    """``contamination`` of rows of ``key`` (of any type, not null) and ``text``; ``key`` takes the place of ``doc_id``."""
    windows = materialize(_windows(benchmark, item_id, item_text, width), "windows")
    sizes = sorted(r[0] for r in windows.select(F.least("len", F.lit(shingle)).alias("k")).distinct().collect())
    folded = windows.select("wid", "len", F.col("win").alias("w"), F.least("len", F.lit(shingle)).alias("k"))
    tokens = [folded.where(F.col("k") == k).select(
        "wid", "len", F.lit(k).alias("k"), F.posexplode(_shingles("w", k)).alias("offset", "h")) for k in sizes]
    if tokens:
        of_windows = materialize(reduce(DataFrame.unionByName, tokens), "tokens")
        known = of_windows.select("k", "h").distinct()
        if known.count() <= broadcast_rows:
            known = F.broadcast(known)
        worded = rows.select("key", _words(F.col("text")).alias("w"))
        seen = [worded.select("key", F.size("w").alias("n"), F.posexplode(_shingles("w", k)).alias("pos", "h"))
                .withColumn("k", F.lit(k)).join(known, ["k", "h"]) for k in sizes]
        matches = materialize(reduce(DataFrame.unionByName, seen), "matches")
        rarity = matches.groupBy("k", "h").agg(F.count(F.lit(1)).alias("df"))
        prefix = (of_windows.join(rarity, ["k", "h"], "left")
                  .groupBy("wid", "len", "k")
                  .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "h")).alias("rarest"))
                  .where("rarest.df > 0").select("wid", "len", "k", "rarest.offset", "rarest.h"))
        starts = (matches.join(prefix, ["k", "h"])
                  .select("key", "wid", "len", "n", (F.col("pos") - F.col("offset")).alias("start"))
                  .where("start >= 0 and start + len <= n"))
        found = (starts.join(windows.select("wid", F.array_join("win", " ").alias("win"), "items"), "wid")
                 .groupBy("key").agg(F.collect_set(F.struct("start", "len", "win", "items")).alias("maybe")))
        rows = rows.join(found, "key", "left")
    else:
        rows = rows.withColumn("maybe", F.lit(None).cast("array<struct<start:int,len:int,win:string,items:array<string>>>"))
    hits = (rows.select("key", _words(F.col("text")).alias("w"), "maybe")
            .select("key", F.size("w").alias("n_words"), F.expr(
                "filter(maybe, c -> array_join(slice(w, c.start + 1, c.len), ' ') = c.win)").alias("hit")))
    items = F.expr("array_sort(array_distinct(flatten(transform(hit, c -> c.items))))")
    spots = F.expr("array_distinct(flatten(transform(hit, c -> sequence(c.start, c.start + c.len - 1))))")
    per_doc = hits.select(
        "key", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(F.size(F.when(F.size("hit") > 0, spots)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(items, F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.transform("hit", lambda c: F.struct(c["start"].alias("start"), c["len"].alias("len"))),
                   F.array().cast("array<struct<start:int,len:int>>")).alias("hits"))
    return per_doc.select(
        "key", "n_words",
        F.when(F.col("n_hit") > 0, F.col("n_hit")).otherwise(0).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "hits")
