"""Source divergence audit: how the word use of every source differs from that of the others in its language.

Terms are runs of ASCII letters and of characters from U+0080 on, with A-Z lower-cased. A task keeps word-start
pointers into the bytes of its Arrow batches and sorts them, a shard of ``shard_bytes`` at a time, by multikey
quicksort over characters of eight bytes: every slice of pointers that agree so far is cut around a
pivot character into a smaller, an equal and a larger slice, all slices in the same numpy steps, and an equal slice goes
on with its next character or, where its words end, is a run of one term. Runs give the counts of each (lang, source) and the number of documents, which
Spark adds up; no text is shuffled.

A term is kept in a language if at least ``least_docs`` documents of that language hold it. With ``c`` occurrences in a
group, ``N`` of all kept terms there and ``V`` kept terms, its share is ``p = 1 + floor(10**9 * (c + 5) / (N + 5 * V))``, worked out in whole
numbers. Two sources differ by the sum of ``|p - q|`` over all kept terms of their language; a term stands out in a group where its share
is above the one in the whole language.

A null text, lang or source is ''. A document is a row; repeated rows count again. A group without terms takes part with all counts
0, and values are 0 where no term is kept. Ties are ordered by the UTF-8 bytes of the item. An empty table gives no rows; columns other than the three are not
read. One very long text is a shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stored, tidied

SMOOTH = 5
UNIT = 10**9

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_IS_TERM = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_WIDTH = 8  # bytes of a character of the sort


def word_pointers(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every term in ``data``, whose texts lie between successive ``bounds``."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_TERM[data]
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside[:-1] & ~inside[1:]
    last[edges - 1] |= inside[edges - 1]
    return starts, np.flatnonzero(last) + 1 - starts


def characters(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
    """The ``depth``-th eight bytes of every word as one number that orders like them; zeros stand behind a word's end.

    ``data`` is lower-cased and has at least eight bytes behind its last word.
    """
    windows = np.ndarray((len(data) - _WIDTH + 1,), ">u8", data, strides=(1,))
    left = lengths - depth * _WIDTH
    found = windows[np.minimum(starts + depth * _WIDTH, len(windows) - 1)].astype(np.uint64)
    short = np.clip(_WIDTH - left, 0, _WIDTH).astype(np.uint64) * np.uint64(8)
    return np.where(left <= 0, np.uint64(0), (found >> np.minimum(short, 63)) << np.minimum(short, 63))


def sorted_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in the order of their words, equal words in the order given, and the place where each run of equal words begins.

    A stable three-way quicksort: all slices that are not sorted yet are cut around their pivots in the same steps.
    """
    n = len(starts)
    order, heads = np.arange(n), np.zeros(n + 1, bool)
    heads[0] = True
    keys = characters(data, starts, lengths, 0)
    low, high, depth = (np.array([x] if n else [], np.int64) for x in (0, n, 0))
    while len(low):
        sizes = high - low
        ends = np.cumsum(sizes)
        first = ends - sizes
        place = np.arange(ends[-1]) + np.repeat(low - first, sizes)
        own = keys[place]
        middle = np.sort(np.stack([own[first], own[first + sizes // 2], own[ends - 1]]), 0)[1]
        pivot = np.repeat(middle, sizes)
        less, more = own < pivot, own > pivot
        before_less, before_more = (np.concatenate([[0], np.cumsum(x)]) for x in (less, more))
        n_less, n_more = (x[ends] - x[first] for x in (before_less, before_more))
        same_low, same_high = low + n_less, high - n_more
        # where each element goes: behind those of its kind that stand before it in its slice
        ahead_less, ahead_more = (x[:-1] - np.repeat(x[first], sizes) for x in (before_less, before_more))
        to = place - ahead_less - ahead_more + np.repeat(n_less, sizes)
        to[less] = (np.repeat(low, sizes) + ahead_less)[less]
        to[more] = (np.repeat(same_high, sizes) + ahead_more)[more]
        order[to], keys[to] = order[place], own
        heads[same_low] = heads[same_high] = True
        # words of an equal slice that are longer go on with the next character; the others are a run
        on = (n_less + n_more < sizes - 1) & ((middle & np.uint64(0xFF)) != 0)
        on_low, on_size, on_depth = same_low[on], (same_high - same_low)[on], depth[on] + 1
        at = np.arange(on_size.sum()) + np.repeat(on_low - (np.cumsum(on_size) - on_size), on_size)
        keys[at] = characters(data, starts[order[at]], lengths[order[at]], np.repeat(on_depth, on_size))
        some_less, some_more = n_less > 1, n_more > 1
        low, high, depth = (
            np.concatenate([low[some_less], on_low, same_high[some_more]]),
            np.concatenate([same_low[some_less], on_low + on_size, high[some_more]]),
            np.concatenate([depth[some_less], on_depth, depth[some_more]]),
        )
    return order, np.flatnonzero(heads[:n])


def _run_counts(data: np.ndarray, bounds: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, group, occurrences, documents) of each term in each group; texts are ordered by group."""
    data = np.concatenate([_LOWER[data], np.zeros(_WIDTH, np.uint8)])
    starts, lengths = word_pointers(data[:-_WIDTH], bounds)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 5
    text = np.searchsorted(bounds, starts, side="right") - 1
    order, runs = sorted_runs(data, starts, lengths)
    text = text[order]
    of = group[text]
    new_text, new_group = np.ones(len(order), bool), np.ones(len(order), bool)
    new_text[1:] = text[1:] != text[:-1]
    new_group[1:] = of[1:] != of[:-1]
    new_text[runs] = new_group[runs] = True
    heads = np.flatnonzero(new_group)
    times = np.diff(np.append(heads, len(order)))
    chosen = order[heads]
    return starts[chosen], lengths[chosen], of[heads], times, np.add.reduceat(new_text.astype(np.int64), heads)


def _slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of ``most`` bytes together; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def _as_column(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The words at ``starts`` as an Arrow string column."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(_LOWER[values[at]])).cast(pa.string())


def _groups_of(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.RecordBatch]:
    """Number of the (lang, source) of each row of a batch ordered by them, and the pairs by number."""
    codes = [batch.column(c).dictionary_encode().indices.to_numpy() for c in ("lang", "source")]
    new = np.ones(batch.num_rows, bool)
    new[1:] = (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1])
    return np.cumsum(new) - 1, batch.select(["lang", "source"]).filter(pa.array(new))


_COUNTED = ["lang", "source", "term"]


def _added(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by(_COUNTED, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns([*_COUNTED, "n", "docs"])


def texts_in_groups(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).alias("text"))


def term_counts(rows: DataFrame, *, shard_bytes: int = 8_000_000, held_rows: int = 1_000_000) -> DataFrame:
    """(lang, source, term, n, docs) of ``rows`` (lang, source, text): occurrences of each term in each group and the texts that hold it.

    A task adds up the runs of its shards until there are ``held_rows`` of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            batch = batch.sort_by([("lang", "ascending"), ("source", "ascending")])  # a run of equal words then falls into groups
            group, names = _groups_of(batch)
            texts = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            values = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for first, end in _slices(offsets, shard_bytes):
                begin = int(offsets[first])
                part = values[begin : int(offsets[end])]
                starts, lengths, of, times, texts_with = _run_counts(part, offsets[first:end] - begin, group[first:end])
                own = names.take(pa.array(of))
                columns = [*own.columns, _as_column(part, starts, lengths), pa.array(times, pa.int64()), pa.array(texts_with, pa.int64())]
                held.append(pa.table(columns, names=[*_COUNTED, "n", "docs"]))
                if sum(t.num_rows for t in held) > held_rows:
                    held = [_added(held)]
                    if held[0].num_rows > held_rows // 2:
                        yield from held.pop().to_batches(100_000)
        if held:
            yield from _added(held).to_batches(100_000)

    found = rows.mapInArrow(tidied(run), "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy(*_COUNTED).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """Counts of the terms that enough documents of their language hold, with ``n_lang``, the occurrences in the language, and ``first`` in one row of each term."""
    term = Window.partitionBy("lang", "term")
    marked = counts.withColumns(
        {"held": F.sum("docs").over(term), "n_lang": F.sum("n").over(term), "first": F.row_number().over(term.orderBy("source")) == 1}
    )
    return marked.where(F.col("held") >= least_docs).select(*_COUNTED, "n", "n_lang", "first")


def totals(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, kept, total_lang, sources) of every group, also of those without terms."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").fillna(0, ["total"])
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total_lang"), F.count("*").alias("sources"))
    vocabulary = kept.where("first").groupBy("lang").agg(F.count("*").alias("kept"))
    return groups.join(langs.join(vocabulary, "lang", "left").fillna(0, ["kept"]), "lang")


def _share(count: str, total: str) -> Column:
    """``1 + floor(10**9 * (count + 5) / (total + 5 * kept))`` in whole numbers."""
    return F.expr(f"1 + (CAST({count} + {SMOOTH} AS DECIMAL(20,0)) * {UNIT}) div CAST({total} + {SMOOTH} * kept AS DECIMAL(20,0))")


def shares(counts: np.ndarray, under: np.ndarray) -> np.ndarray:
    """The same of arrays, by long division so that nothing exceeds 64 bits; 1 where ``under`` is 0."""
    under = np.maximum(under, 1)
    out, rest = np.divmod(counts + SMOOTH, under)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, under)
        out = out * 1000 + digits
    return out + 1


def standing_out(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms of each group whose share is furthest above the one in the language."""
    both = kept.where("n > 0").join(groups, ["lang", "source"]).select(*_COUNTED, _share("n", "total").alias("p"), _share("n_lang", "total_lang").alias("q"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    found = both.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top)


def _pair_sums(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """(lang, a, b, value) of each two sources a < b: what the terms of one bucket add to their difference."""
    groups = groups.sort_by("source")
    sources = groups.column("source").to_pylist()
    place = {s: i for i, s in enumerate(sources)}
    under = groups.column("total").to_numpy() + SMOOTH * groups.column("kept").to_numpy()
    terms, term = np.unique(counts.column("hash").to_numpy(), return_inverse=True)
    table = np.repeat(shares(np.zeros(len(under), np.int64), under)[:, None], len(terms), 1)
    own = np.fromiter((place[s] for s in counts.column("source").to_pylist()), np.int64, counts.num_rows)
    table[own, term] = shares(counts.column("n").to_numpy(), under[own])
    out = []
    for i in range(len(sources) - 1):
        apart = np.abs(table[i + 1 :] - table[i]).sum(1)
        columns = [pa.array([key[0].as_py()] * len(apart), pa.string()), pa.array([sources[i]] * len(apart), pa.string()), pa.array(sources[i + 1 :], pa.string()), pa.array(apart, pa.int64())]
        out.append(pa.table(columns, names=["lang", "a", "b", "value"]))
    return pa.concat_tables(out) if out else pa.table({"lang": pa.array([], pa.string()), "a": pa.array([], pa.string()), "b": pa.array([], pa.string()), "value": pa.array([], pa.int64())})


def apart(kept: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """For each group every other source of its language, the most different one first.

    The terms of a language are dealt out by hash, so that a task holds about ``cells`` shares. Two terms of a bucket are told
    apart by a second hash of 64 bits.
    """
    size = groups.withColumn("buckets", F.ceil((F.col("kept") + 1) * F.col("sources") / cells).cast("int"))
    per_lang = size.select("lang", "buckets").distinct()
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket")
    left = kept.join(per_lang, "lang").select("lang", bucket, "source", F.xxhash64(F.lit("term"), "term").alias("hash"), "n")
    right = size.select("lang", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), "source", "total", "kept")
    sums = left.groupBy("lang", "bucket").cogroup(right.groupBy("lang", "bucket")).applyInArrow(_pair_sums, "lang string, a string, b string, value bigint")
    total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    each = total.select("lang", "value", F.inline(sides)).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return each.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def divergence(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30, top: int = 50, shard_bytes: int = 8_000_000, cells: int = 2_000_000
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds the other sources of a group's language, part ``term`` the terms that stand out in it."""
    rows = texts_in_groups(docs, text_col, lang_col, source_col)
    kept = stored(kept_terms(term_counts(rows, shard_bytes=shard_bytes), least_docs), "kept-terms")
    groups = stored(totals(rows, kept), "group-totals")
    return apart(kept, groups, cells).unionByName(standing_out(kept, groups, top))
