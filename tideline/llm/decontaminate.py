"""Benchmark decontamination by Wu-Manber search over words.

A text is a sequence of words: ASCII letters lower-cased, runs of ASCII digits, letters and any
non-ASCII characters. A benchmark item gives one pattern for each window of ``window`` consecutive words;
an item with fewer words, but at least one, is a single pattern. A symbol of the search is a word.

Search: patterns are kept by length. For each length a shift table says, for the last two words read, how far the
search may jump because no pattern has these words nearer to its end; most pairs of words are in no
pattern at all, so that a document is looked at once in about ``window`` words. Where the shift is zero,
the hash of the same words picks the bucket of patterns that end with them, and each is compared word for word.

Null or wordless texts have no words and hit nothing; items that are null, have no words or no id give no patterns.
Repeated items and documents are judged row by row. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import as_bytes, fresh, pick, with_columns

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def patterns_of(text: bytes | None, window: int) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


class Table:
    """Wu-Manber tables of patterns that all have ``length`` words."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length, self.block = length, min(2, length)
        self.furthest = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[str]]]] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.furthest), length - end)
            self.buckets[pattern[-self.block :]].append((pattern, items))

    def search(self, words: list[bytes], found: list[tuple[int, int]], items: set[str]) -> None:
        length, block, shift, furthest = self.length, self.block, self.shift, self.furthest
        end, n = length, len(words)
        while end <= n:
            key = tuple(words[end - block : end])
            jump = shift.get(key, furthest)
            if jump:
                end += jump
                continue
            for pattern, owners in self.buckets[key]:
                if tuple(words[end - length : end]) == pattern:
                    found.append((end - length, end))
                    items.update(owners)
            end += 1


def build(patterns: list[tuple[bytes, str]]) -> list[Table]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
    for text, item in patterns:
        words = tuple(text.split(b" "))
        by_length[len(words)][words].append(item)
    return [Table(n, p) for n, p in sorted(by_length.items())]


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    chosen = pick(items, id_col, text_col).where("doc_id IS NOT NULL AND text IS NOT NULL")
    chosen = chosen.withColumn("doc_id", F.col("doc_id").cast("string"))
    field = T.StructType([T.StructField("windows", T.ArrayType(T.BinaryType()))])
    cut = with_columns(chosen, ["text"], lambda: lambda texts: [[sorted(patterns_of(t, window)) for t in as_bytes(texts)]], field)
    return cut.select(F.explode("windows").alias("window"), F.col("doc_id").alias("item")).distinct()


def mark(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 13,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 32 << 20,
) -> tuple[DataFrame, str, str, str]:
    """``docs`` with three columns appended (their names are returned too): the number of words, the ranges of words
    inside any occurrence, and the ids of the items that occur.

    The patterns travel to the executors in blocks of about ``block_bytes``, by a hash of the pattern; each block is one
    more pass over the rows, in place. A benchmark of any size is thus searched, and nothing larger is ever broadcast.
    """
    spark = docs.sparkSession
    windows = _windows(items, window, item_id_col, item_text_col)
    size = windows.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    n_words, spans, found = fresh(docs, "n_words"), fresh(docs, "hit_spans"), fresh(docs, "hit_items")
    fields = T.StructType(
        [T.StructField(n_words, T.LongType()), T.StructField(spans, _SPANS), T.StructField(found, T.ArrayType(T.StringType()))]
    )
    out, order = docs, docs.columns
    for k in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect() if size else []
        shared = spark.sparkContext.broadcast([(bytes(r["window"]), r["item"]) for r in part])

        def start(shared=shared):
            tables = build(shared.value)

            def work(texts: pa.Array, old_spans: pa.Array | None = None, old_items: pa.Array | None = None):
                counts, ranges, names = [], [], []
                before = zip(old_spans.to_pylist(), old_items.to_pylist(), strict=True) if old_spans is not None else None
                for text in as_bytes(texts):
                    words, hit, seen = words_of(text), [], set()
                    if before:
                        had, seen = next(before)
                        hit, seen = [(s["start"], s["end"]) for s in had], set(seen)
                    for table in tables:
                        table.search(words, hit, seen)
                    counts.append(len(words))
                    ranges.append([{"start": a, "end": b} for a, b in union(hit)])
                    names.append(sorted(seen))
                return counts, ranges, names

            return work

        if k == 0:
            out = with_columns(out, [text_col], start, fields)
        else:  # the former block's columns take on the new finds
            renamed = [fresh(out, c) for c in (n_words, spans, found)]
            out = out.withColumnsRenamed(dict(zip((n_words, spans, found), renamed, strict=True)))
            out = with_columns(out, [text_col, *renamed[1:]], start, fields).select(*order, n_words, spans, found)
    return out, n_words, spans, found


def hits(spans: str):
    """Number of words inside the ranges."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_share: int = 20, **how) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, spans, items, contaminated.

    A document is contaminated if a ``least_share``-th of its words or more lies inside occurrences.
    """
    marked, n, spans, found = mark(pick(docs, id_col, text_col), items, **how)
    n_hit = hits(spans)
    return marked.select(
        "doc_id",
        F.col(n).alias("n_words"),
        n_hit.alias("n_hit"),
        F.col(spans).alias("spans"),
        F.col(found).alias("items"),
        ((n_hit > 0) & (least_share * n_hit >= F.col(n))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, *, least_share: int = 20, **how) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    marked, n, spans, _ = mark(docs, items, **how)
    n_hit = hits(spans)
    return marked.where(~((n_hit > 0) & (least_share * n_hit >= F.col(n)))).select(*docs.columns)
