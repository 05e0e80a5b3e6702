"""Language identification by compression.

For each language a zstandard dictionary of raw content is made of sample texts. A text is compressed
with every dictionary; the one that makes it smallest names the language. Texts are cut into blocks of
``BLOCK`` bytes that are compressed one by one, so that the dictionary speaks for the whole text and
not only for its beginning. Where the margin to the runner-up is narrow the answer is marked as rejected.

Scale: the sample is bounded (``sample_rows`` rows in all, ``dictionary_bytes`` a language) and picked by
a hash of the row's identifier; the dictionaries travel with the code. Each text is then handled alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tokens

BLOCK = 4096
_LETTER = re.compile(r"[^\W\d_]")


def _folded(data: bytes) -> bytes:
    """Capitals say nothing about a language."""
    return data.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass")


def sample_texts(docs: DataFrame, trained: Column, doc_id: str, text: str, lang: str,
                 sample_rows: int) -> tuple[DataFrame, list[str]]:
    """About ``sample_rows`` training rows, equally many for each language but one at least, by the hash of the identifier.

    Beside them the languages, the most frequent first.
    """
    rows = docs.where(trained & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(doc_id), F.lit("sample")), F.lit(1 << 30)).alias("order"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("low")).collect()  # one row a language
    each = max(1, sample_rows // max(1, len(counts)))
    cuts = [F.lit(x) for r in counts for x in (r["lang"], max(int((1 << 30) * min(1.0, each / r["n"])), r["low"] + 1))]
    cut = F.coalesce(F.try_element_at(F.create_map(*cuts), F.col("lang")), F.lit(0)) if cuts else F.lit(0)
    return rows.where(F.col("order") < cut), [r["lang"] for r in sorted(counts, key=lambda r: (-r["n"], r["lang"]))]


def dictionaries(sample: DataFrame, dictionary_bytes: int) -> dict[str, bytes]:
    """Per language whole sample texts in hash order, the first ones up to ``dictionary_bytes``.

    Nearest to the end, where references are cheapest, stands the first text.
    """
    out: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for r in sample.orderBy("lang", "order", "text").toLocalIterator():
        have = size.get(r["lang"], 0)
        if have < dictionary_bytes:
            piece = _folded(r["text"].encode("utf-8", "surrogatepass"))[:dictionary_bytes - have]
            out.setdefault(r["lang"], []).append(piece)
            size[r["lang"]] = have + len(piece)
    return {k: b"\n".join(reversed(v)) for k, v in out.items() if any(v)}


def _identify(known: dict[str, bytes], names: list[str], margin: float, level: int):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = []
        for name in names:
            data = zstandard.ZstdCompressionDict(known[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            tools.append(zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=False,
                                                  write_content_size=False, write_dict_id=False))
        for batch in batches:
            texts, ids, rows = tokens.Texts(batch["text"]), batch["doc_id"].to_pylist(), []
            for i, doc in enumerate(ids):
                data = _folded(texts[i])
                if not names or not _LETTER.search(data.decode("utf-8", "surrogatepass")):
                    rows.append((doc, "und", 0.0, True))
                    continue
                blocks = [data[k:k + BLOCK] for k in range(0, len(data), BLOCK)]
                sizes = np.array([sum(len(t.compress(x)) for x in blocks) for t in tools], dtype=np.float64)
                best = int(np.argmin(sizes))
                gap = (np.partition(sizes, 1)[1] - sizes[best]) / sizes[best] if len(sizes) > 1 else 1.0
                rows.append((doc, names[best], float(gap / (gap + margin)), bool(gap < margin)))
                if len(rows) >= 1000:
                    yield tokens.batch(schema, rows)
                    rows = []
            yield tokens.batch(schema, rows)
    return run


def identify(docs: DataFrame, trained: Column | None = None, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang", sample_rows: int = 2000, dictionary_bytes: int = 64 << 10,
             margin: float = 0.02, level: int = 6) -> DataFrame:
    """Language of every row of ``docs``, learned from those rows where ``trained`` holds.

    Returns ``doc_id``, ``lang_pred`` (a learned language; ``und`` for null texts, texts without a letter,
    and when nothing was learned; any number of languages is learned,
    from one row each where there are more than ``sample_rows``), ``score`` (0 to 1; one half at ``margin``) and ``rejected`` (the runner-up is
    within ``margin``, as a share of the size). Ties go to the more frequent language. Only ``text`` is read for a
    prediction. Repeated rows are answered alike; a null ``doc_id`` is kept. An empty table gives an empty
    result; other columns are ignored.
    """
    sample, names = sample_texts(docs, F.lit(True) if trained is None else trained, doc_id, text, lang, sample_rows)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = dictionaries(sample, dictionary_bytes)
    return rows.mapInArrow(_identify(known, [n for n in names if n in known], margin, level),
                           "doc_id long, lang_pred string, score double, rejected boolean")
