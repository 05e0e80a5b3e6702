"""Near-duplicate classes by BagMinHash, banding and exact verification.

A text is the multiset of its word shingles. For every shingle, and for every weight interval (0, 1],
(1, 2], (2, 4], (4, 8], ... up to its multiplicity, a Poisson process seeded by shingle and interval
throws points; a point names a register, a time and a weight level, and counts if the level lies below the
multiplicity. A register keeps its earliest point. Two texts then agree in a register with a probability
that equals their weighted Jaccard similarity. Processes stop once they are later than every register.

Texts that agree in all registers of a band share a bucket. The node with most company leads its
bucket and is compared with all members on the real multisets; what links there is one component. Members
of a bucket that are still in different components are compared with each other on the multisets as well, in
blocks inside tasks; only links that join components leave a task. No list of pairs is ever made.

Scale: equal texts are one node; signatures, buckets, links and labels are tables in the shared folder;
hot buckets are cut into blocks of ``BLOCK`` members that go to different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tables, tokens
from panelspark.llm.components import components
from panelspark.runtime import materialize

SHINGLE = 5
# Bands times rows are the registers. At a similarity of 0.8 a pair shares no bucket with probability 5e-6.
BANDS, ROWS = 40, 6
# Members of one bucket that one task compares with each other.
BLOCK = 256


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text with multiplicities: owner, hash, count, sorted by owner and hash.

    Words are in lower case (A-Z). A text of fewer than ``SHINGLE`` words, but not none, is one shingle.
    """
    hashes, bounds = tokens.words(texts, lower=True)
    at, owner = tokens.windows_within(bounds, SHINGLE)
    prefix = tokens.prefix_hash(hashes)
    h = tokens.window_hash(prefix, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    size = np.diff(bounds)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    h = np.concatenate([h, tokens.span_hash(prefix, bounds[short], bounds[short + 1])])
    owner = np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    head = np.ones(len(h), dtype=bool)
    head[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(head)
    return owner[first], h[first], np.diff(first, append=len(h))


def signatures(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Weighted MinHash registers of ``n`` bags: the identity of the earliest accepted point of each register."""
    times = np.full(n * registers, np.inf)
    points = np.zeros(n * registers, dtype=np.uint64)
    # One process per shingle and weight interval: level k covers (2**(k-1), 2**k], level 0 covers (0, 1].
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
    of = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low, high = np.where(level > 0, 2.0 ** (level - 1), 0.0), 2.0 ** level
    doc, weight, rate = owner[of], count[of], high - low
    state = tokens.mix(shingle[of] + tokens.mix(level.astype(np.uint64)))
    time, last = np.zeros(len(of)), np.full(n, np.inf)
    step = 0
    while len(state):
        step += 1
        state = tokens.mix(state + np.uint64(step))
        unit = ((state >> np.uint64(11)).astype(np.float64) + 0.5) / 2 ** 53
        time = time - np.log(unit) / rate
        alive = time < last[doc]
        if not alive.all():
            doc, weight, rate, low, state, time = (x[alive] for x in (doc, weight, rate, low, state, time))
        draw = tokens.mix(state ^ np.uint64(0x5851F42D4C957F2D))
        register = ((draw >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        level_of = low + rate * ((draw & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2 ** 32)
        good = np.flatnonzero(np.floor(level_of) < weight)
        place = doc[good] * registers + register[good]
        order = np.lexsort((time[good], place))
        place, good = place[order], good[order]
        head = np.ones(len(place), dtype=bool)
        head[1:] = place[1:] != place[:-1]
        place, good = place[head], good[head]
        earlier = time[good] < times[place]
        place, good = place[earlier], good[earlier]
        times[place], points[place] = time[good], draw[good]
        last = times.reshape(n, registers).max(axis=1)
    return points.reshape(n, registers)


def overlap(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of two lists, pair by pair; two empty texts are equal."""
    n = len(a)
    owner, shingle, count = bags(a + b)
    pair = owner % n
    order = np.lexsort((shingle, pair))
    pair, shingle, count = pair[order], shingle[order], count[order]
    twin = np.zeros(len(pair), dtype=bool)
    twin[1:] = (pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1])
    at = np.flatnonzero(twin)
    common = np.bincount(pair[at], np.minimum(count[at], count[at - 1]), minlength=n)
    total = np.bincount(pair, count, minlength=n)
    return np.where(total > 0, common / np.maximum(total - common, 1), 1.0)


def _sign(bands: int, rows: int):
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.Texts(batch["text"]).chunks():
                owner, shingle, count = bags(texts)
                points = signatures(owner, shingle, count, b - a, bands * rows)
                size = np.bincount(owner, count, minlength=b - a).astype(np.int64)
                keys = np.zeros((b - a, bands), dtype=np.uint64)
                for r in range(rows):
                    keys = tokens.mix(keys + points[:, r::rows])
                keys = tokens.mix(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)
                of_bands = pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * bands, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch["key"].slice(a, b - a), batch["node"].slice(a, b - a), pa.array(size), of_bands],
                    schema=schema)
    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("body", pa.binary())])
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for a, b, texts in tokens.Texts(batch["text"]).chunks():
            yield pa.RecordBatch.from_arrays([batch["node"].slice(a, b - a),
                                              pa.array([packer.compress(t) for t in texts], pa.binary())], schema=schema)


def _verify(threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                left, right = ([opener.decompress(x.as_py()) for x in part[c]] for c in ("left", "right"))
                found = overlap(left, right)
                keep = pa.array(found >= threshold)
                yield pa.RecordBatch.from_arrays([part["a"].filter(keep), part["b"].filter(keep),
                                                  pa.array(found).filter(keep)], schema=schema)
    return run


def _verified(pairs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose multisets reach the threshold."""
    both = (pairs.join(bodies.select(F.col("node").alias("b"), F.col("body").alias("right")), "b")
            .join(bodies.select(F.col("node").alias("a"), F.col("body").alias("left")), "a"))
    return both.select("a", "b", "left", "right").mapInArrow(_verify(threshold), "a long, b long, similarity double")


def cell_links(node: np.ndarray, comp: np.ndarray, block: np.ndarray, texts: list[bytes],
               threshold: float) -> list[tuple[int, int]]:
    """Links that join the components of a cell's members, each member compared with all it must be.

    Members of one component need no link; in a cell of two blocks only pairs across them count. A member's
    multiset is laid out over the cell's shingles, and all partners are summed up against it at once.
    """
    owner, shingle, count = bags(texts)
    code = np.unique(shingle, return_inverse=True)[1]
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    size = np.bincount(owner, count, minlength=len(texts))
    label, cross, out = comp.copy(), len(np.unique(block)) > 1, []
    mine = np.zeros(len(shingle) + 1, dtype=np.int64)
    for i in range(len(texts) - 1):
        j = np.arange(i + 1, len(texts))
        j = j[(label[j] != label[i]) & (np.minimum(size[j], size[i]) >= threshold * np.maximum(size[j], size[i]))]
        if cross:
            j = j[block[j] != block[i]]
        if not len(j):
            continue
        own = slice(first[i], first[i + 1])
        mine[code[own]] = count[own]
        length = first[j + 1] - first[j]
        at = np.repeat(first[j] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        common = np.bincount(np.repeat(np.arange(len(j)), length), np.minimum(mine[code[at]], count[at]), minlength=len(j))
        mine[code[own]] = 0
        for k in j[common >= threshold * (size[j] + size[i] - common)]:
            if label[k] != label[i]:
                out.append((int(node[i]), int(node[k])))
                label[label == label[k]] = label[i]
    return out


def _compare(threshold: float):
    """Rows come sorted by cell."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(held: list[tuple]) -> pa.RecordBatch:
        node, comp, block, body = zip(*held, strict=True)
        return tokens.batch(schema, cell_links(np.array(node), np.array(comp), np.array(block),
                                               [zstandard.ZstdDecompressor().decompress(x) for x in body], threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                for bucket, low, high, *row in zip(*(part[c].to_pylist() for c in (
                        "bucket", "low", "high", "node", "comp", "block", "body")), strict=True):
                    if (bucket, low, high) != current:
                        if len(held) > 1:
                            yield links(held)
                        current, held = (bucket, low, high), []
                    held.append(row)
        if len(held) > 1:
            yield links(held)

    return run


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Class of every row of ``docs``: connected components of pairs with similarity ``threshold`` or more.

    Similarity is the weighted Jaccard of the multisets of five-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z
    folded; a shorter text is one shingle). Returns ``doc_id``, ``class_id`` (the smallest ``doc_id`` of the class)
    and ``class_rows``. Texts without a word, null included, are alone: their class is their own ``doc_id``. Equal texts
    share a class; a null ``doc_id`` sorts first. An empty table gives an empty result; other columns are ignored.
    """
    signed, comps = _compared(_named(docs, doc_id, text), threshold, bands, rows)
    placed = materialize(signed.where("size > 0").select("key", "node").join(comps, "node", "left")
                         .select("key", F.coalesce("comp", "node").alias("comp")), "placed")
    # written, so that the join below is free of the aggregate's partitioning and a hot class can be split
    classes = materialize(placed.groupBy("comp").agg(F.min("key").alias("class_key"),
                                                     F.count(F.lit(1)).alias("class_rows")), "classes")
    full = placed.join(classes, "comp").select("key", "class_key", "class_rows")
    alone = signed.where("size = 0").select("key", F.col("key").alias("class_key"), F.lit(1).cast("long").alias("class_rows"))
    return full.unionByName(alone).select(tables.id_of(F.col("key")).alias("doc_id"),
                                          tables.id_of(F.col("class_key")).alias("class_id"), "class_rows")


def first_of_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8,
                     bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row of every class of ``near_duplicates``, with all columns of ``docs``.

    A class belongs to rows, not to identifiers: rows with one ``doc_id`` (null as well) and unlike texts are apart. The
    row with the smallest ``doc_id`` stays, among those the one with the smallest digest of all its columns, so reruns
    agree. Rows without a word are alone. Of rows that are equal in all columns one stays.
    """
    named = _named(docs, doc_id, text)
    comps = _compared(named, threshold, bands, rows)[1]
    mark = tables.free_name(docs, "row_digest")
    keyed = docs.withColumn(mark, tables.digest_of(docs))
    held = keyed.select(tables.key_of(doc_id).alias("key"), F.col(mark).alias("row_digest"), F.xxhash64(F.col(text).cast("string")).alias("node"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    placed = held.where("worded").join(comps, "node", "left").select("key", "row_digest", F.coalesce("comp", "node").alias("comp"))
    first = placed.groupBy("comp").agg(F.min(F.struct("key", "row_digest")).alias("first")).select("first.row_digest")
    kept = materialize(first.unionByName(held.where("not worded").select("row_digest").distinct()).select(
        F.col("row_digest").alias(mark)), "kept")
    # equal rows meet on the map side first, so that many of them do not gather
    return keyed.dropDuplicates([mark]).join(kept, mark, "left_semi").select(*docs.columns)


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    given = docs.select(tables.key_of(doc_id).alias("key"), F.col(text).cast("string").alias("text"))
    return given.withColumn("node", F.xxhash64("text"))


def _compared(named: DataFrame, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their node and its size, and the components of the nodes that have links."""
    signed = materialize(named.mapInArrow(
        _sign(bands, rows), "key long, node long, size long, bands array<long>"), "signed")
    nodes = materialize(signed.where("size > 0").groupBy("node").agg(
        F.min("key").alias("key"), F.first("size").alias("size"), F.first("bands").alias("bands")), "nodes")
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = materialize(spread.join(shared, "bucket"), "members")

    company = members.groupBy("node").agg(F.sum("members").alias("company"))
    ranked = members.join(company, "node")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("company", "node")).alias("top")).select(
        "bucket", F.col("top.node").alias("leader"))
    pairs = materialize(members.join(leaders, "bucket").where("node <> leader").groupBy(
        F.col("node").alias("a"), F.col("leader").alias("b")).agg(F.count(F.lit(1)).alias("n")).drop("n"), "pairs")
    wanted = company.select("node").join(nodes.select("node", "key"), "node")
    bodies = materialize(named.join(wanted, ["node", "key"], "left_semi").mapInArrow(_compress, "node long, body binary")
                         .dropDuplicates(["node"]), "bodies")
    links = materialize(_verified(pairs, bodies, threshold), "links")
    comps = components(links)

    labelled = members.select("bucket", "node").join(comps, "node", "left").select(
        "bucket", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                           F.count(F.lit(1)).alias("n")).where("lo <> hi")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    cells = (labelled.join(mixed.select("bucket", blocks.alias("blocks")), "bucket")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("bucket", "node", "comp", "block", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"))
             .join(bodies, "node"))
    more = materialize(cells.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
                       .mapInArrow(_compare(threshold), "a long, b long").distinct(), "links")
    if not more.isEmpty():
        comps = components(links.select("a", "b").unionByName(more))
    return signed, comps
