"""Near-duplicates by SimHash, found with a generalised pigeonhole index.

Fingerprint: ASCII-lower-cased words between ASCII white space, shingles of ``width`` words (a shorter text is one
shingle), XXH64 with seed 42 of each, repeats included; a bit is set if it is set in over half of the hashes.
A text without words has fingerprint zero, which links like any other.

Two fingerprints link if they differ in at most ``radius`` bits. The search is exact:

1. Bits that go together are put in the same partition: the correlation of every two bits is summed over all
   fingerprints, and partitions grow by the most correlated bit left.
2. If each partition ``i`` has a threshold ``t_i >= -1`` and the ``t_i + 1`` add up to ``radius + 1``, a fingerprint
   within ``radius`` is within ``t_i`` of the probe in some partition. Each probe gets its own thresholds by dynamic
   programming over the partitions, so that the expected number of candidates, plus the number of keys to
   look up, is least. Candidates are estimated from counts of the values of small groups of bits, whose distance
   distributions are convolved; these tables have a fixed size.
3. Index rows (the value of each partition) and probe rows (all values within the threshold) meet in buckets. A bucket
   is searched breadth first, so every link is verified and the links that come out are a spanning forest of the
   bucket's: copies by the thousand give no pairs of copies. Buckets above ``most_rows`` are cut into chunks of
   which every two meet, so no task holds a whole hot bucket.
4. Links become classes by connected components.

The number of partitions follows from the number of different fingerprints, so that keys keep being selective.
Documents with equal fingerprints are one fingerprint from the first shuffle on. Null texts have no words; rows with
a null id are no documents and are left out. Rows that repeat an id are judged one by one, each by its own text. An empty table
gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import as_bytes, fresh, pick, split_hot, stored, tidied, with_columns
from tideline.llm.components import components

BITS = 64
GROUP = 8  # bits of a group for estimates
_ONE = np.uint64(1)


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-width].tolist()]
        stops = (ends[width - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)]
    total, chunk = np.zeros(BITS, np.int64), 1 << 16
    for i in range(0, len(hashes), chunk):
        part = np.array(hashes[i : i + chunk], np.uint64)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, *, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``bits`` (the fingerprint as a signed 64-bit number) of each document with an id."""

    def start():
        return lambda texts: [[fingerprint(t, width) for t in as_bytes(texts)]]

    chosen = pick(docs, id_col, text_col).where("doc_id IS NOT NULL")
    return with_columns(chosen, ["text"], start, T.StructType([T.StructField("bits", T.LongType())])).drop("text")


# Partitions -------------------------------------------------------------------------------------


def _unpack(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for every two bits how many have both; 64 rows leave each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for b in batches:
            bits = b.column(0).to_numpy()
            for i in range(0, len(bits), 1 << 16):
                rows = _unpack(np.ascontiguousarray(bits[i : i + (1 << 16)])).astype(np.float32)
                total += rows.T @ rows
                n += len(rows)
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(BITS), pa.int32()), "n": pa.array([n] * BITS, pa.int64()), "both": pa.array(total.astype(np.int64).tolist(), pa.list_(pa.int64()))})

    parts = prints.select("bits").mapInArrow(tidied(run), "i int, n bigint, both array<bigint>")
    sums = parts.select("i", "n", F.posexplode("both").alias("j", "both")).groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("both").alias("both"))
    both, n = np.zeros((BITS, BITS)), 0
    for r in sums.collect():  # 64 x 64 rows at any size
        both[r["i"], r["j"]], n = r["both"], r["n"]
    return n, both


def arrange(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` partitions of near equal width, correlated bits together."""
    share = both / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    bond = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    left, out = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        seed = max(sorted(left), key=lambda b: sum(bond[b, c] for c in left if c != b))
        own = [seed]
        left.remove(seed)
        while len(own) < width:
            best = max(sorted(left), key=lambda b: sum(bond[b, c] for c in own))
            own.append(best)
            left.remove(best)
        out.append(sorted(own))
    return out


def value_of(bits: np.ndarray, places: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, as a number."""
    u = bits.view(np.uint64)
    out = np.zeros(len(u), np.uint64)
    for k, place in enumerate(places):
        out |= ((u >> np.uint64(place)) & _ONE) << np.uint64(k)
    return out


def group_counts(prints: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """How many fingerprints have each value of each group of bits: a table of 64 / GROUP x 2**GROUP numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(groups), 1 << GROUP), np.int64)
        for b in batches:
            bits = np.ascontiguousarray(b.column(0).to_numpy())
            for g, places in enumerate(groups):
                counts[g] += np.bincount(value_of(bits, places).astype(np.int64), minlength=1 << GROUP)
        yield pa.RecordBatch.from_pydict({"g": pa.array(range(len(groups)), pa.int32()), "counts": pa.array(counts.tolist(), pa.list_(pa.int64()))})

    rows = prints.select("bits").mapInArrow(tidied(run), "g int, counts array<bigint>")
    sums = rows.select("g", F.posexplode("counts").alias("v", "c")).groupBy("g", "v").agg(F.sum("c").alias("c"))
    out = np.zeros((len(groups), 1 << GROUP))
    for r in sums.collect():
        out[r["g"], r["v"]] = r["c"]
    return out


def near_shares(counts: np.ndarray, radius: int) -> np.ndarray:
    """[group, value, d]: the share of fingerprints whose group value is at distance d, up to ``radius``."""
    groups, values = counts.shape
    exact = np.zeros((groups, values, radius + 1))
    exact[:, :, 0] = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    flip = np.arange(values)
    for bit in range(GROUP):
        other = exact[:, flip ^ (1 << bit), :]
        exact[:, :, 1:] += other[:, :, :-1]
    return exact


class Plan:
    """Partitions, estimates, and the thresholds of each fingerprint."""

    def __init__(self, n: int, partitions: list[list[int]], shares: dict[tuple[int, int], np.ndarray], radius: int, probe_cost: float = 0.25):
        self.n, self.partitions, self.shares, self.radius, self.probe_cost = n, partitions, shares, radius, probe_cost
        self.masks = {
            (i, d): np.array([sum(1 << b for b in flips) for flips in itertools.combinations(range(len(p)), d)], np.uint64)
            for i, p in enumerate(partitions)
            for d in range(radius + 1)
        }

    def costs(self, bits: np.ndarray) -> np.ndarray:
        """[partition, fingerprint, units]: expected work for threshold ``units - 1``; no work for no units."""
        out = np.zeros((len(self.partitions), len(bits), self.radius + 2))
        for i, places in enumerate(self.partitions):
            spread = np.zeros((len(bits), self.radius + 1))
            spread[:, 0] = 1
            for g in range(0, len(places), GROUP):
                near = self.shares[i, g][value_of(bits, places[g : g + GROUP]).astype(np.int64)]
                spread = np.stack([sum(spread[:, a] * near[:, d - a] for a in range(d + 1)) for d in range(self.radius + 1)], 1)
            keys = np.cumsum([math.comb(len(places), d) for d in range(self.radius + 1)])
            out[i, :, 1:] = np.cumsum(spread, 1) * self.n + keys * self.probe_cost
        return out

    def thresholds(self, bits: np.ndarray) -> np.ndarray:
        """[fingerprint, partition], -1 where a partition is not probed."""
        costs, budget = self.costs(bits), self.radius + 1
        best = np.full((len(bits), budget + 1), np.inf)
        best[:, 0] = 0
        taken = []
        for cost in costs:
            options = np.full((len(bits), budget + 1, budget + 1), np.inf)  # [fingerprint, units so far, units here]
            for total in range(budget + 1):
                for here in range(total + 1):
                    options[:, total, here] = best[:, total - here] + cost[:, here]
            taken.append(options.argmin(2))
            best = options.min(2)
        out, left = np.zeros((len(bits), len(costs)), np.int64), np.full(len(bits), budget)
        for i in range(len(costs) - 1, -1, -1):
            here = taken[i][np.arange(len(bits)), left]
            out[:, i], left = here - 1, left - here
        return out

    def rows(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(partition, key, fingerprint, probe?) of all index and probe rows. A threshold of zero needs no row besides the index row."""
        chosen = self.thresholds(bits)
        part, key, print_, probe = [], [], [], []
        for i, places in enumerate(self.partitions):
            own = value_of(bits, places)
            for d in range(self.radius + 1):
                asked = np.ones(len(bits), bool) if d == 0 else chosen[:, i] >= d
                if not asked.any():
                    continue
                masks = self.masks[i, d]
                key.append((own[asked][:, None] ^ masks[None, :]).ravel())
                print_.append(np.repeat(bits[asked], len(masks)))
                part.append(np.full(len(key[-1]), i, np.int32))
                probe.append(np.full(len(key[-1]), d > 0))
        return np.concatenate(part), np.concatenate(key).view(np.int64), np.concatenate(print_), np.concatenate(probe)


def plan(prints: DataFrame, radius: int = 3, spare_bits: int = 2) -> Plan:
    n, both = bit_statistics(prints)
    parts = max(1, min(radius + 1, BITS // max(1, math.ceil(math.log2(max(n, 2))) + spare_bits)))
    partitions = arrange(n, both, parts)
    groups = [(i, g, p[g : g + GROUP]) for i, p in enumerate(partitions) for g in range(0, len(p), GROUP)]
    near = near_shares(group_counts(prints, [g[2] for g in groups]), radius)
    return Plan(n, partitions, {(i, g): near[k] for k, (i, g, _) in enumerate(groups)}, radius)


# Buckets ----------------------------------------------------------------------------------------


def forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span each component of the fingerprints within ``radius`` of each other.

    Breadth first: what is reached leaves the set that is still compared, so a dense group costs little more than its size.
    """
    left = np.unique(prints.view(np.uint64))
    a, b = [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                got = left[near]
                a.append(np.full(len(got), x, np.uint64))
                b.append(got)
                queue.extend(got)
                left = left[~near]
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)


def _search(radius: int):
    """Rows sorted by (part, key, chunks): links within each run of equal keys."""

    def links(keys: np.ndarray, bits: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        edge = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        starts, stops = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
        sizes = stops - starts
        pairs = starts[sizes == 2]
        near = np.bitwise_count((bits[pairs] ^ bits[pairs + 1]).view(np.uint64)) <= radius
        found = [(bits[pairs[near]], bits[pairs[near] + 1])] if near.any() else []
        for s, e in zip(starts[sizes > 2], stops[sizes > 2], strict=True):
            found.append(forest(bits[s:e], radius))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_bits = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)

        def out(found):
            for a, b in found:
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], 1)
            held_keys, held_bits = np.concatenate([held_keys, keys]), np.concatenate([held_bits, batch.column(4).to_numpy()])
            last = int(np.flatnonzero(np.any(held_keys != held_keys[-1], axis=1))[-1]) + 1 if np.any(held_keys != held_keys[-1]) else 0
            if last:
                yield from out(links(held_keys[:last], held_bits[:last]))
                held_keys, held_bits = held_keys[last:], held_bits[last:]
        if len(held_keys):
            yield from out(links(held_keys, held_bits))

    return run


def near_links(prints: DataFrame, *, radius: int = 3, most_rows: int = 50_000) -> DataFrame:
    """(a, b): links between different fingerprints; every link of the input is a path of these. ``prints`` has one row a fingerprint in ``bits``."""
    how = plan(prints, radius)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = np.ascontiguousarray(b.column(0).to_numpy())
            for i in range(0, len(bits), 4096):
                part, key, print_, probe = how.rows(bits[i : i + 4096])
                yield pa.RecordBatch.from_pydict({"part": pa.array(part), "key": pa.array(key), "bits": pa.array(print_), "probe": pa.array(probe)})

    rows = prints.select("bits").mapInArrow(tidied(emit), "part int, key bigint, bits bigint, probe boolean")
    # A bucket without an index row, or with a single row, has no candidates.
    counted = rows.groupBy("part", "key").agg(F.count("*").alias("n"), F.bool_or(~F.col("probe")).alias("indexed"))
    sizes = stored(counted.where("n > 1 AND indexed"), "buckets")
    live = rows.drop("probe").join(sizes.select("part", "key"), ["part", "key"])
    hot = sizes.where(F.col("n") > most_rows).select("part", "key", F.col("n").alias("bucket_n"))
    cut = split_hot(live, ["part", "key"], ["bits"], most_rows, hot).select("part", "key", "c", "d", "bits")
    placed = cut.repartition("part", "key", "c", "d").sortWithinPartitions("part", "key", "c", "d")
    return placed.mapInArrow(tidied(_search(radius)), "a bigint, b bigint")


def classes(prints: DataFrame, *, radius: int = 3, most_rows: int = 50_000) -> DataFrame:
    """``prints`` (doc_id, bits) with ``component_id``: the smallest doc_id reachable over links."""
    prints = stored(prints, "fingerprints")
    distinct = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    links = near_links(distinct, radius=radius, most_rows=most_rows)
    roots = components(links)
    named = distinct.join(roots, distinct["bits"] == roots["node"], "left").select("bits", "first_id", F.coalesce("root", "bits").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = named.join(least, "root").select("bits", "component_id")
    return prints.join(by_print, "bits").select("doc_id", "bits", "component_id")


def near_duplicates(docs: DataFrame, *, radius: int = 3, width: int = 3, id_col: str = "doc_id", text_col: str = "text", most_rows: int = 50_000) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    found = classes(fingerprints(docs, width=width, id_col=id_col, text_col=text_col), radius=radius, most_rows=most_rows)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each class, with all its columns.

    A document is told by its id and a hash of its text, so texts that share an id are judged apart. The one with the least
    (id, hash) stays; of rows that repeat it one stays. Rows without an id stay.
    """
    key, own = fresh(docs, "near_text_key"), fresh(docs, "near_document")
    keyed = docs.withColumn(key, F.xxhash64(F.col(text_col).cast("string")))
    named = keyed.where(F.col(id_col).isNotNull()).withColumn(own, F.struct(F.col(id_col).alias("id"), F.col(key).alias("key")))
    found = classes(fingerprints(named, id_col=own, text_col=text_col, **({"width": how.pop("width")} if "width" in how else {})), **how)
    counted = found.groupBy("doc_id").agg(F.first("component_id").alias("lead"), F.count("*").alias("n")).where("doc_id <> lead OR n > 1")
    marks = stored(counted.select(F.col("doc_id.id").alias("__id"), F.col("doc_id.key").alias("__key"), (F.col("doc_id") == F.col("lead")).alias("__leads")), "near-copies")
    same = (F.col("__id") == F.col("__doc.id")) & (F.col("__key") == F.col("__doc.key"))
    row = keyed.select(F.struct(F.col(id_col).alias("id"), F.col(key).alias("key")).alias("__doc"), F.struct(*docs.columns).alias("__row"))
    rest = row.join(marks, same, "left_anti").select("__row.*")
    repeated = row.join(marks.where("__leads"), same, "left_semi")
    return rest.unionAll(repeated.groupBy("__doc").agg(F.first("__row").alias("__row")).select("__row.*"))
