"""Packing documents into sequences with their lexical neighbours.

A document is its subword ids and one end id. Each task reads its documents in shards of about ``shard_bytes`` of text,
in the order they stand in, and builds a BM25 inverted index of each shard. A sequence starts with a seed: the document
that is cut by the end of the sequence before it, else the next unused one. Unused neighbours of the seed, best first (its
rarest words of those that another document has are the query), fill the sequence; what does not fit starts the next one. Where a seed
has no unused neighbour left, the next unused document goes on. So every sequence of a task but its last is full, also from one shard to the next.

Last sequences of the tasks are put together whole, longest first, where they fit. What is left short is padded, or
not at all where its length is a power of two. No text is shuffled; memory is bounded by a shard (or one longer text).

A null text is an empty one: its end id is all. Rows stand for themselves, also with equal or null ids. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm import subwords
from tideline.llm.common import as_bytes, pick, stored, tidied

class Index:
    """BM25 over the documents of a shard, given by the term numbers of each."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75, query_terms: int = 24):
        self.query_terms = query_terms
        lengths = np.array([len(d) for d in docs], float)
        terms, places = np.unique(np.concatenate([*docs, np.zeros(0, np.int64)]), return_inverse=True)
        owner = np.repeat(np.arange(len(docs)), lengths.astype(np.int64))
        width = max(len(docs), 1)
        pairs, times = np.unique(places * width + owner, return_counts=True)
        self.term, self.doc = pairs // width, pairs % width
        counts = np.bincount(self.term, minlength=len(terms))
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.counts = counts
        self.idf = np.log(1 + (len(docs) - counts + 0.5) / (counts + 0.5))
        norm = k1 * (1 - b + b * lengths / max(lengths.mean() if len(lengths) else 1, 1))
        self.weight = self.idf[self.term] * times * (k1 + 1) / (times + norm[self.doc])
        order = np.argsort(self.doc, kind="stable")
        self.by_doc, self.doc_starts = self.term[order], np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=len(docs)))])

    few = 48

    def neighbours(self, doc: int, used: np.ndarray) -> Iterator[int]:
        """Unused documents that share a query term with ``doc``, best first."""
        own = self.by_doc[self.doc_starts[doc] : self.doc_starts[doc + 1]]
        own = own[self.counts[own] > 1]
        if len(own) > self.query_terms:
            own = own[np.argpartition(-self.idf[own], self.query_terms)[: self.query_terms]]
        if not len(own):
            return
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in own]
        found = np.concatenate([self.doc[s] for s in spans])
        weight = np.concatenate([self.weight[s] for s in spans])
        every = np.bincount(found, weights=weight, minlength=len(used))
        every[used] = 0
        docs = np.flatnonzero(every)
        scores = every[docs]
        if len(docs) > 2 * self.few:  # the best are nearly always enough
            best = np.argpartition(-scores, self.few)
            best, rest = best[: self.few], best[self.few :]
            yield from docs[best[np.lexsort((best, -scores[best]))]]
            yield from docs[rest[np.lexsort((rest, -scores[rest]))]]
        else:
            yield from docs[np.argsort(-scores, kind="stable")]


class Packer:
    """Fills sequences one after the other; pieces come out as they are placed."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence, self.fill = window, first_sequence, 0
        self.pieces: list[tuple] = []  # row, start, length, crc, doc_tokens, sequence, offset

    def place(self, row: int, ids: np.ndarray) -> bool:
        """Put a whole document down; True if it went past the end of a sequence."""
        at, rolled = 0, False
        while at < len(ids):
            n = min(len(ids) - at, self.window - self.fill)
            self.pieces.append((row, at, n, zlib.crc32(ids[at : at + n].astype("<u4").tobytes()), len(ids), self.sequence, self.fill))
            at, self.fill = at + n, self.fill + n
            if self.fill == self.window:
                self.sequence, self.fill, rolled = self.sequence + 1, 0, True
        return rolled


def order_shard(packer: Packer, ids: list[np.ndarray], index: Index) -> None:
    """Place every document of a shard."""
    used = np.zeros(len(ids), bool)
    upcoming, seed, near = 0, None, iter(())
    while True:
        doc = next((int(d) for d in near if not used[d]), None)
        if doc is None:
            while upcoming < len(ids) and used[upcoming]:
                upcoming += 1
            if upcoming == len(ids):
                return
            doc, seed = upcoming, None
        used[doc] = True
        rolled = packer.place(doc, ids[doc])
        if packer.fill == 0:  # a sequence is just full: the next one has a fresh seed
            seed, near = None, iter(())
        elif rolled or seed is None:
            seed = doc
            near = index.neighbours(seed, used)


_NUMBERS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 1, window: int = 2048, shard_bytes: int = 16 << 20, query_terms: int = 24, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with ``with_ids`` also its ids."""
    chosen = pick(docs, id_col, text_col)
    path = tokenizer or subwords.default_path()
    schema = T.StructType([chosen.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in _NUMBERS), T.StructField("last", T.BooleanType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = subwords.Chunks(subwords.load(path))
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        for names, texts in _shards(batches, shard_bytes):
            ids, docs_terms = [], []
            for i in range(0, len(texts), 512):
                some, numbers = chunks.encode_all(texts[i : i + 512])
                ids += [np.append(x, np.uint32(end_id)) for x in some]
                terms = chunks.term_numbers()
                docs_terms += [terms[n] for n in numbers]
            order_shard(packer, ids, Index(docs_terms, query_terms=query_terms))
            yield from out(names, ids, packer)

    def out(names: pa.Array, ids: list[np.ndarray], packer: Packer) -> Iterator[pa.RecordBatch]:
        """All pieces so far; those of the sequence that is still open are marked, as the next shard may go on with it."""
        rows, packer.pieces = packer.pieces, []
        if not rows:
            return
        columns = [names.take(pa.array([r[0] for r in rows]))]
        columns += [pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 7)]
        columns.append(pa.array([r[5] == packer.sequence and packer.fill > 0 for r in rows]))
        if with_ids:
            columns.append(pa.array([ids[r[0]][r[1] : r[1] + r[2]].astype(np.int64) for r in rows], pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    pieces = stored(chosen.mapInArrow(tidied(run), schema), "pieces")
    return _join_last(pieces, window).drop("last")


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    names, texts, size = [], [], 0
    for batch in batches:
        own = [t or b"" for t in as_bytes(batch.column(1))]
        start = 0
        for i, t in enumerate(own):
            size += len(t)
            if size >= shard_bytes:
                names.append(batch.column(0).slice(start, i + 1 - start))
                yield pa.concat_arrays(names), texts + own[start : i + 1]
                names, texts, size, start = [], [], 0, i + 1
        if start < len(own):
            names.append(batch.column(0).slice(start))
            texts += own[start:]
    if texts:
        yield pa.concat_arrays(names), texts


def _join_last(pieces: DataFrame, window: int, group: int = 4096) -> DataFrame:
    """Sequences that tasks left short, put together whole: first fit, longest first, within groups of about ``group`` of them."""
    by_sequence = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.bool_or("last").alias("last"))
    short = stored(by_sequence.where(F.col("last") & (F.col("n") < window)).select("sequence_id", "n"), "short-sequences")
    groups = max(1, -(-short.count() // group))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "sequence_id"], ascending=[False, True])
        open_: list[list[int]] = []  # sequence, fill
        moved = []
        for sequence, n in zip(rows["sequence_id"], rows["n"], strict=True):
            for o in open_:
                if o[1] + n <= window:
                    moved.append((sequence, o[0], o[1]))
                    o[1] += n
                    break
            else:
                moved.append((sequence, sequence, 0))
                open_.append([sequence, n])
        return pd.DataFrame(moved, columns=["sequence_id", "into", "shift"])

    moves = short.groupBy(F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("g")).applyInPandas(fit, "sequence_id bigint, into bigint, shift bigint")
    joined = pieces.join(moves, "sequence_id", "left")
    return joined.withColumns({"offset": F.col("offset") + F.coalesce("shift", F.lit(0)), "sequence_id": F.coalesce("into", "sequence_id")}).select(*pieces.columns)
