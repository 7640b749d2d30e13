"""Line dedup as an exact set-similarity join of lines.

A line is the set of its words (ASCII letters lower-cased, between ASCII white space). Lines with one set are a
class. A line is removed if an earlier line, in (doc_id, hash of the text, line number) order, has the same set or a Jaccard
similarity of ``similarity`` or more with it, whether or not that line is removed itself.

1. Words are counted over the corpus into a table of fixed size by hash. The words of a line are ordered by that count,
   then by hash: any one order is right, this one puts rare words first (counts are compared by their powers of two).
2. Two sets as similar as asked share a word among their first ``n - ceil(similarity * n) + 1``: the prefix. Each class
   sends one small row for each word of its prefix: size, position, the word before, and a 64-bit sketch.
3. In the bucket of a word, two classes are candidates if the size filter, the positional filter (words left after the
   shared one) and the sketch (it bounds the symmetric difference) allow it. If the words before the shared one are
   the same, the pair belongs to an earlier bucket. Classes that have a candidate go on; most lines end here.
4. Word sets of those classes alone are gathered. A bitmap of fixed greatest size tells which lines may be meant;
   what it lets through needlessly falls out in the join. Each bucket is verified in order of position. A class
   needs one earlier match, so groups of copies cost little more than their size, and no pairs are put out.

Buckets with more rows than ``most_rows`` are cut into chunks of which every two meet. Sets and words are told apart by
64-bit hashes. Lines without a word, and rows with a null id or text, stay as they are. Rows with equal ids and texts are one
document; with equal ids and other texts they are different documents. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import as_bytes, bitmap, emptied, fresh, groups, in_bitmap, joined_by_text, pick, split_hot, stored, text_keys, tidied, with_columns, written

TABLE_BITS = 18
SLICES = 4
_BLOCK = 4096


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b" \t\n\v\f\r")] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_OF_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LEVEL_SHIFT = np.uint64(59)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, b)])) for b in (_BASE, _BASE_INVERSE))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words between ASCII white space in some bytes.

    All are hashed together: bytes times powers of a base are summed up, and a word is a difference of two sums, brought
    to a common power.
    """
    space = np.ones(len(buffer) + 2, bool)
    space[1:-1] = _IS_SPACE[buffer]
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = _POWERS.upto(max(len(buffer), 1))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_OF_BYTE[buffer] * up[: len(buffer)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def run_hashes(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run ``numbers[start:end]``."""
    up, down = _POWERS.upto(max(len(numbers), 1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers * up[: len(numbers)])])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _flat(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, line index) of every word, and (text index, line number) of every line with a word."""
    joined = b"\n".join(t or b"" for t in texts).lower()
    buffer = np.frombuffer(joined, np.uint8)
    if not len(buffer):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    hashes, starts, _ = word_hashes(buffer)
    breaks = np.flatnonzero(buffer == 10)
    line = np.cumsum(np.bincount(np.searchsorted(starts, breaks), minlength=len(starts) + 1))[: len(starts)]
    sizes = np.fromiter((0 if t is None else t.count(b"\n") for t in texts), np.int64, len(texts)) + 1
    first = np.cumsum(sizes) - sizes
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    used, dense = line[new], np.cumsum(new) - 1
    owner = np.searchsorted(first, used, side="right") - 1
    return hashes, dense, owner, (used - first[owner]).astype(np.int32)


def rarity(docs: DataFrame) -> np.ndarray:
    """How often words stand in the corpus, by the low bits of their hash: an array of 2**TABLE_BITS counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TABLE_BITS, np.int64)
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for begin, end in groups(texts):
                flat, *_ = _flat(texts[begin:end])
                np.add.at(counts, (flat & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64), 1)
        blocks = counts.reshape(-1, _BLOCK)
        used = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(used, pa.int32()), "counts": pa.array([b.tobytes() for b in blocks[used]], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in table.column("counts").to_pylist())
        return pa.table({"block": table.column("block")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    parts = docs.select("text").mapInArrow(tidied(run), "block int, counts binary")
    # first sums within groups of tasks, then over groups, so that no task meets the blocks of all tasks
    grouped = parts.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(64)))
    sums = grouped.groupBy("block", "g").applyInArrow(lambda t: add(t), "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary")
    out = np.zeros((1 << TABLE_BITS) // _BLOCK * _BLOCK, np.int64).reshape(-1, _BLOCK)
    for r in sums.collect():
        out[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


class Lines:
    """Word sets of the lines of some texts. A word is its rarity (5 bits) before 59 bits of its hash, so numbers are in order of rarity."""

    def __init__(self, texts: list[bytes | None], table: np.ndarray):
        flat, line, self.owner, self.number = _flat(texts)
        times = table[(flat & np.uint64(len(table) - 1)).astype(np.int64)]
        level = np.minimum(np.frexp(times.astype(np.float64))[1], 31).astype(np.uint64)
        words = level << _LEVEL_SHIFT | flat >> np.uint64(5)
        sorted_runs(words, np.bincount(line, minlength=len(self.owner)))
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
        self.words, line = words[new], line[new]
        self.sizes = np.bincount(line, minlength=len(self.owner))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        if len(self.words):
            self.classes = mix(np.add.reduceat(mix(self.words), self.starts) + self.sizes.astype(np.uint64)).view(np.int64)
            self.sketches = sketches(self.words, self.starts)
        else:
            self.classes = self.sketches = np.zeros(0, np.int64)


def sorted_runs(values: np.ndarray, sizes: np.ndarray) -> None:
    """Sorts in place each of the runs of these sizes that ``values`` consist of; runs of one size are rows of one matrix."""
    if not len(sizes):
        return
    starts = np.cumsum(sizes) - sizes
    by_size = np.argsort(sizes, kind="stable")
    kinds, first = np.unique(sizes[by_size], return_index=True)
    for n, same in zip(kinds.tolist(), np.split(starts[by_size], first[1:]), strict=True):
        if n > 1:
            at = same[:, None] + np.arange(n)
            values[at] = np.sort(values[at], axis=1)


def sketches(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The parity of the words that fall on each of 64 bits: two sets differ in at least as many words as their sketches in bits."""
    return np.bitwise_xor.reduceat(np.uint64(1) << (words & np.uint64(63)), starts).view(np.int64)


def least_overlap(total: np.ndarray, similarity: float) -> np.ndarray:
    """Words two sets of ``total`` words together must share."""
    return np.ceil(similarity / (1 + similarity) * total - 1e-9).astype(np.int64)


def prefix_length(n: np.ndarray, similarity: float) -> np.ndarray:
    return n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1


def line_table(docs: DataFrame, table: np.ndarray, similarity: float, most_rows: int) -> DataFrame:
    """(doc_id, text_key, line, class, n, sketch, prefix, rare) of each line with a word. ``rare`` words of the prefix are too rare for a hot bucket."""
    shared, common = docs.sparkSession.sparkContext.broadcast(table), int(np.log2(most_rows))
    fields = {"text_key": pa.int64(), "line": pa.int32(), "class": pa.int64(), "n": pa.int32(), "sketch": pa.int64(), "prefix": pa.list_(pa.int64()), "rare": pa.int32()}
    spark_kinds = {pa.int64(): T.LongType(), pa.int32(): T.IntegerType(), pa.list_(pa.int64()): T.ArrayType(T.LongType())}
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(k, spark_kinds[v]) for k, v in fields.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for begin, end in groups(texts):
                yield rows(batch.column(0).slice(begin, end - begin), texts[begin:end], counts)

    def rows(ids: pa.Array, texts: list[bytes | None], counts: np.ndarray) -> pa.RecordBatch:
        keys = text_keys(texts)
        found = Lines(texts, counts)
        n = found.sizes
        smallest = np.ceil(similarity * n - 1e-9)  # sets that only equal sets can match send nothing
        alone = (smallest >= n) & (np.floor(n / similarity + 1e-9) <= n)
        length = np.where(alone, 0, prefix_length(n, similarity))
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        take = np.repeat(found.starts - offsets[:-1], length) + np.arange(offsets[-1])
        prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.words[take].view(np.int64)))
        # a word of level k stands fewer than 2**k times
        hot = np.concatenate([[0], np.cumsum((found.words[take] >> _LEVEL_SHIFT).astype(np.int64) > common)])
        rare = length - (hot[offsets[1:]] - hot[offsets[:-1]])
        made = {"text_key": keys[found.owner], "line": found.number, "class": found.classes, "n": n, "sketch": found.sketches, "prefix": prefix, "rare": rare}
        columns = [ids.take(pa.array(found.owner)), *(v if isinstance(v, pa.Array) else pa.array(v, fields[k]) for k, v in made.items())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(tidied(run), schema)


# Candidates -------------------------------------------------------------------------------------


def _may_match(a: dict[str, np.ndarray], b: dict[str, np.ndarray], similarity: float) -> np.ndarray:
    """Whether rows of one bucket are candidates; arrays are broadcast against each other."""
    need = least_overlap(a["n"] + b["n"], similarity)
    left = np.minimum(a["n"] - a["pos"], b["n"] - b["pos"])  # the shared word and what follows
    differ = np.bitwise_count((a["sketch"] ^ b["sketch"]).view(np.uint64))
    return (
        (a["class"] != b["class"])
        & ((a["prev"] != b["prev"]) | (a["pos"] == 0) | (b["pos"] == 0))
        & (np.minimum(a["n"], b["n"]) >= similarity * np.maximum(a["n"], b["n"]) - 1e-9)
        & (left >= need)
        & (differ <= a["n"] + b["n"] - 2 * need)
    )


def _candidates(similarity: float, most_small: int = 48, block: int = 2048):
    names = ("class", "prev", "n", "pos", "sketch")

    def look_large(rows: dict[str, np.ndarray]) -> np.ndarray:
        """The same for one large bucket of different classes. Rows with one and the same word before are never candidates of each other."""
        order = np.argsort(rows["prev"], kind="stable")
        rows = {c: v[order] for c, v in rows.items()}
        n = len(order)
        same = [rows["prev"][i] if rows["pos"][i : i + block].min() > 0 and rows["prev"][i] == rows["prev"][min(i + block, n) - 1] else None for i in range(0, n, block)]
        hit = np.zeros(n, bool)
        for i in range(0, n, block):
            wanted = np.arange(i, min(i + block, n))
            for j in range(0, n, block):
                wanted = wanted[~hit[wanted]]
                if not len(wanted):
                    break
                if same[i // block] is not None and same[i // block] == same[j // block]:
                    continue
                own = {c: v[wanted][:, None] for c, v in rows.items()}
                hit[wanted] = _may_match(own, {c: v[j : min(j + block, n)][None, :] for c, v in rows.items()}, similarity).any(1)
        out = np.zeros(n, bool)
        out[order] = hit
        return out

    def look(keys: np.ndarray, rows: dict[str, np.ndarray]) -> np.ndarray:
        """Which rows have a candidate in their bucket."""
        edge = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        starts, stops = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
        end = np.repeat(stops, stops - starts)
        hit = np.zeros(len(keys), bool)
        small = (end - np.repeat(starts, stops - starts)) <= most_small
        at = np.flatnonzero(small)
        for k in range(1, most_small):
            at = at[at + k < end[at]]
            if not len(at):
                break
            ok = at[_may_match({c: v[at] for c, v in rows.items()}, {c: v[at + k] for c, v in rows.items()}, similarity)]
            hit[ok] = hit[ok + k] = True
        for s, e in zip(starts, stops, strict=True):
            if e - s > most_small:
                _, first, inverse = np.unique(rows["class"][s:e], return_index=True, return_inverse=True)
                hit[s:e] = look_large({c: v[s:e][first] for c, v in rows.items()})[inverse]
        return hit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches, 1):
            keys = table.column(0).to_numpy()
            same = keys[1:] == keys[:-1]
            shared = np.flatnonzero(np.append(False, same) | np.append(same, False))  # most buckets have one row alone
            table, keys = table.take(pa.array(shared)), keys[shared, None]
            hit = look(keys, {c: table.column(c).to_numpy().astype(np.int64) for c in names})
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(keys[hit, 0]), "class": pa.array(table.column("class").to_numpy()[hit])})

    return run


def whole_buckets(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted batches put together so that no run of equal keys (the first columns) is cut."""
    held: list[pa.RecordBatch] = []

    def last_run(b: pa.RecordBatch) -> int:
        same = np.ones(b.num_rows, bool)
        for i in range(keys):
            column = b.column(i).to_numpy()
            same &= column == column[-1]
        other = np.flatnonzero(~same)
        return int(other[-1]) + 1 if len(other) else 0

    for b in batches:
        if not b.num_rows:
            continue
        cut = last_run(b)
        if held and any(b.column(i)[0] != held[-1].column(i)[0] for i in range(keys)):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks()
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def candidates(classes: DataFrame, similarity: float, most_rows: int) -> DataFrame:
    """(bucket, class), once each, of each class with a candidate in that bucket. ``classes`` has one row for each class, so buckets count classes and not lines.

    A bucket is a word, or for a hot word the hash of it and of two chunks. Should two hashes be equal, two buckets are one, which costs
    comparisons and loses none.
    """
    rows = classes.where(F.size("prefix") > 0).select("class", "n", "sketch", "rare", "prefix", F.posexplode("prefix").alias("pos", "token"))
    rows = rows.select("token", "class", F.when(F.col("pos") > 0, F.element_at("prefix", F.greatest("pos", F.lit(1)))).otherwise(F.lit(0)).alias("prev"), "n", "pos", "sketch", (F.col("pos") >= F.col("rare")).alias("common"))
    hot = stored(rows.where("common").groupBy("token").agg(F.count("*").alias("bucket_n")).where(F.col("bucket_n") > most_rows), "hot-tokens")
    cut = split_hot(rows, ["token"], ["class"], most_rows, hot)
    whole = (F.col("c") == 0) & (F.col("d") == 0)
    cut = cut.select("token", "common", F.when(whole, F.col("token")).otherwise(F.xxhash64("token", "c", "d")).alias("bucket"), "class", "prev", "n", "pos", "sketch")
    found = []
    for k in range(SLICES):
        # a word that is not common has one bucket, itself: its slice is known before the join
        own = cut.where(F.col("common") | in_slice(F.col("token"), k)).where(in_slice(F.col("bucket"), k))
        placed = own.drop("token", "common").repartition("bucket").sortWithinPartitions("bucket")
        found.append(stored(placed.mapInArrow(tidied(_candidates(similarity)), "bucket bigint, class bigint").distinct(), "candidates"))
    return reduce(DataFrame.unionAll, found)


def in_slice(key: Column, k: int) -> Column:
    """Whether a bucket or class, which are hashes themselves, is in the k-th share. Shares are gone through one after another, so that not all rows are in the shuffle at once."""
    return F.pmod(key, F.lit(SLICES)) == k


# Verification -----------------------------------------------------------------------------------


def word_sets(docs: DataFrame, table: np.ndarray, bits: np.ndarray) -> DataFrame:
    """(class, words) of the lines whose class may be in the bitmap; ``words`` are sorted 64-bit hashes."""
    shared = docs.sparkSession.sparkContext.broadcast((table, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, wanted = shared.value
        for found in (Lines(texts[i:j], counts) for batch in batches for texts in [as_bytes(batch.column(0))] for i, j in groups(texts)):
            ok = np.flatnonzero(in_bitmap(wanted, found.classes))
            ok = ok[np.unique(found.classes[ok], return_index=True)[1]]
            sets = [found.words[found.starts[i] : found.starts[i] + found.sizes[i]].tobytes() for i in ok]
            yield pa.RecordBatch.from_pydict({"class": pa.array(found.classes[ok]), "words": pa.array(sets, pa.binary())})

    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("text").mapInArrow(tidied(run), "class bigint, words binary")
    return rows.groupBy("class").agg(F.first("words").alias("words"))


class Sets:
    """Word sets one after the other: the place of each word in the order of all of them, which is cheaper to compare."""

    def __init__(self, words: pa.Array):
        ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4) >> 3
        flat = np.frombuffer(words.buffers()[2], np.uint64, ends[-1])[ends[0] :]
        self.starts, self.sizes = (ends[:-1] - ends[0]).astype(np.int64), np.diff(ends).astype(np.int64)
        self.sketches = sketches(flat, self.starts)
        distinct, place = np.unique(flat, return_inverse=True)
        self.flat, self.distinct = place.astype(np.int64), len(distinct)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the sets ``a[i]`` and ``b[i]`` share, for each i."""
        found = np.zeros(len(a), np.int64)
        for k in range(0, len(a), 4096):
            left, right = self._numbered(a[k : k + 4096]), self._numbered(b[k : k + 4096])
            at = np.minimum(np.searchsorted(right, left), len(right) - 1)
            same = left[right[at] == left] // self.distinct
            found[k : k + 4096] = np.bincount(same, minlength=len(a[k : k + 4096]))
        return found

    def _numbered(self, which: np.ndarray) -> np.ndarray:
        """Words of the sets, told apart by their place in ``which``, in ascending order."""
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        words = self.flat[np.repeat(self.starts[which] - ends + sizes, sizes) + np.arange(ends[-1])]
        return np.repeat(np.arange(len(which)), sizes) * self.distinct + words

    def match(self, a: np.ndarray, b: np.ndarray, classes: np.ndarray, similarity: float) -> np.ndarray:
        """Whether the sets ``a[i]`` and ``b[i]`` are of different classes and as similar as asked."""
        total = self.sizes[a] + self.sizes[b]
        need = least_overlap(total, similarity)
        differ = np.bitwise_count((self.sketches[a] ^ self.sketches[b]).view(np.uint64))
        out = (classes[a] != classes[b]) & (np.minimum(self.sizes[a], self.sizes[b]) >= need) & (differ <= total - 2 * need)
        at = np.flatnonzero(out)
        out[at] = self.shared(a[at], b[at]) >= need[at]
        return out


def _verify(similarity: float, most_small: int = 48, block: int = 256):
    """Buckets sorted by position: classes that have an earlier match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches, 3):
            keys = np.stack([table.column(i).to_numpy() for i in range(3)], 1)
            edge = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            starts, stops = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
            classes, sets = table.column("class").to_numpy(), Sets(table.column("words").combine_chunks().cast(pa.binary()))
            hit = np.zeros(len(keys), bool)
            # small buckets: each row with the one k rows earlier, over all buckets at once
            begin, size = np.repeat(starts, stops - starts), np.repeat(stops - starts, stops - starts)
            at = np.flatnonzero(size <= most_small)
            for k in range(1, most_small):
                at = at[(at - k >= begin[at]) & ~hit[at]]
                if not len(at):
                    break
                hit[at] = sets.match(at - k, at, classes, similarity)
            # large ones: each row with blocks of earlier ones, until one matches
            for s, e in zip(starts, stops, strict=True):
                for i in range(s + 1, e if e - s > most_small else s):
                    for j in range(s, i, block):
                        earlier = np.arange(j, min(j + block, i))
                        if sets.match(earlier, np.full(len(earlier), i), classes, similarity).any():
                            hit[i] = True
                            break
            yield pa.RecordBatch.from_pydict({"class": pa.array(classes[hit], pa.int64())})

    return run


def _buckets_in_slice(k: int) -> Column:
    return F.filter("buckets", lambda bucket: in_slice(bucket, k))


def removed_lines(docs: DataFrame, *, similarity: float = 0.8, most_rows: int = 20_000) -> DataFrame:
    """(doc_id, text_key, lines): sorted numbers of the lines to remove, of each document that loses one. ``docs`` has doc_id and text."""
    table = rarity(docs)
    made, made_path = written(line_table(docs, table, similarity, most_rows), "lines")
    place = F.struct("doc_id", "text_key", "line")
    alike = [F.first(c).alias(c) for c in ("n", "sketch", "prefix", "rare")]  # the same in all lines of a class
    grouped = [written(made.where(in_slice(F.col("class"), k)).groupBy("class").agg(F.min(place).alias("place"), F.count("*").alias("times"), *alike), "first-lines") for k in range(SLICES)]
    classes = reduce(DataFrame.unionAll, [part for part, _ in grouped])
    lines = stored(made.select("class", "doc_id", "text_key", "line"), "line-places")
    emptied(docs.sparkSession, made_path)
    active = candidates(classes, similarity, most_rows)
    first = stored(classes.select("class", "place", "times"), "first-places")
    for _, path in grouped:
        emptied(docs.sparkSession, path)
    chosen = stored(active.groupBy("class").agg(F.collect_list("bucket").alias("buckets")), "candidate-classes")
    sets = word_sets(docs, table, bitmap(chosen, "class"))
    known = stored(sets.join(chosen, "class").join(first, "class").select("class", "place", "words", "buckets"), "word-sets")
    hot = stored(active.groupBy("bucket").agg(F.count("*").alias("bucket_n")).where(F.col("bucket_n") > most_rows), "hot-candidates")
    found = []
    for k in range(SLICES):
        own = known.select("class", "place", "words", F.explode(_buckets_in_slice(k)).alias("bucket"))
        cut = split_hot(own, ["bucket"], ["class"], most_rows, hot)
        ordered = cut.select("bucket", "c", "d", "class", "place", "words").repartition("bucket", "c", "d").sortWithinPartitions("bucket", "c", "d", "place")
        found.append(stored(ordered.drop("place").mapInArrow(tidied(_verify(similarity)), "class bigint").distinct(), "matched-classes"))
    matched = reduce(DataFrame.unionAll, found).distinct()
    decided = first.join(matched.withColumn("matched", F.lit(True)), "class", "left").where("times > 1 OR matched")
    gone = lines.select("class", "doc_id", "text_key", "line").join(decided, "class").where(F.col("matched").isNotNull() | (place != F.col("place")))
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def _without(text: bytes, gone: list[int]) -> bytes:
    if not gone:
        return text
    drop = set(gone)
    return b"\n".join(line for k, line in enumerate(text.split(b"\n")) if k not in drop)


def rewritten(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns of ``docs``, with clean text, n_lines and removed (line numbers) appended under the names in the mapping."""
    gone = stored(removed_lines(pick(docs, id_col, text_col), **how), "removed-lines")
    names = {c: fresh(docs, f"line_{c}") for c in ("text", "n_lines", "removed", "gid", "gkey")}
    gone = gone.select(F.col("doc_id").alias(names["gid"]), F.col("text_key").alias(names["gkey"]), F.col("lines").alias(names["removed"]))

    some, rest = joined_by_text(docs, gone, id_col, text_col, names["gid"], names["gkey"], names["n_lines"], lambda texts: [0 if t is None else t.count(b"\n") + 1 for t in texts])

    def start():
        def work(texts: pa.Array, removed: pa.Array):
            cut = [None if t is None else _without(t, g or []) for t, g in zip(as_bytes(texts), removed.to_pylist(), strict=True)]
            try:
                return [pa.array(cut, pa.binary()).cast(pa.string())]
            except pa.ArrowInvalid:  # bytes that are no UTF-8
                return [[None if t is None else t.decode(errors="replace") for t in cut]]

        return work

    cut = with_columns(some, [text_col, names["removed"]], start, T.StructType([T.StructField(names["text"], T.StringType())]))
    as_it_was = rest.withColumns({names["removed"]: F.lit(None).cast("array<int>"), names["text"]: F.col(text_col)})
    return cut.unionByName(as_it_was), names


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row for each document: doc_id, text, n_lines, removed (line numbers from 0, empty if none)."""
    out, names = rewritten(pick(docs, id_col, text_col), **how)
    removed = F.coalesce(F.col(names["removed"]), F.array().cast("array<int>"))
    return out.select("doc_id", F.col(names["text"]).alias("text"), F.col(names["n_lines"]).alias("n_lines"), removed.alias("removed"))


def with_lines_removed(docs: DataFrame, *, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with clean texts; all other columns stay."""
    out, names = rewritten(docs, text_col=text_col, **how)
    return out.select(*[F.col(names["text"]).alias(c) if c == text_col else F.col(c) for c in docs.columns])
