"""Substring dedup over sliding spans of sentences.

Sentences end after words that end in ``.``, ``!`` or ``?`` and at line ends. They are cut further, so that the cuts of a copied passage
fall on the same words wherever it stands: of every ``window`` words in a row, the text is cut after the one with the least hash (the last
of equal ones). Thus no piece has more than ``window`` words, and whatever surrounds a passage moves cuts only within ``window`` words of its
edges: with the values given here any two copies of 51 words share a span. Sentences are compared by their words, ASCII
letters in lower case, white space aside; words are told apart by 64-bit hashes.

From each sentence one span runs over ``least_sentences`` sentences or more, as far as it takes to have ``least_words``
words. Spans are joined over the whole corpus by a 128-bit hash of their words. The first span of a hash is the
one with the least (doc_id, hash of the text, sentence). Sentences covered by any other span of the hash are removed,
also within one document. Everything else stays as it was, to the character.

Rows with equal ids and texts are one document: they are treated alike, and do not repeat each other. Rows with equal ids and
other texts are different documents. Rows without an id cannot be placed: they neither repeat nor are removed
from. Null texts stay null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import as_bytes, bitmap, fresh, groups, in_bitmap, joined_by_text, pick, stored, text_keys, tidied, with_columns
from tideline.llm.line_dedup import mix, run_hashes, word_hashes

_LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


class Pieces:
    """The sentences of some texts, all worked out together.

    ``first`` and ``last`` are the words of a piece by number, ``owner`` its text, ``begin`` the first piece of each text, and a last bound.
    """

    def __init__(self, texts: list[bytes | None], window: int):
        buffer = np.frombuffer(b"\n".join(t or b"" for t in texts).lower(), np.uint8)
        self.hashes, self.starts, ends = word_hashes(buffer)
        sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        self.offsets = np.cumsum(sizes) - sizes
        text = np.searchsorted(self.offsets, self.starts, side="right") - 1
        n = len(text)
        self.cut = np.zeros(n, bool)
        if n:
            breaks = np.flatnonzero(buffer == 10)
            self.cut[-1] = True
            self.cut[:-1] = np.searchsorted(breaks, ends[:-1]) < np.searchsorted(breaks, self.starts[1:])
            self.cut |= _ENDS[buffer[ends - 1]]
        if n >= window:
            rows = n - window + 1
            least, at = self.hashes[:rows].copy(), np.arange(rows)
            for k in range(1, window):
                lower = self.hashes[k : k + rows] <= least
                least[lower] = self.hashes[k : k + rows][lower]
                at[lower] = np.flatnonzero(lower) + k
            self.cut[at[text[:rows] == text[window - 1 :]]] = True
        self.last = np.flatnonzero(self.cut)
        self.first = np.concatenate([[0], self.last[:-1] + 1]).astype(np.int64) if n else self.last
        self.owner = text[self.first]
        self.begin = np.searchsorted(self.owner, np.arange(len(texts) + 1))

    def counts(self) -> np.ndarray:
        """Pieces with a word, of each text."""
        return np.diff(self.begin)

    def spans(self, least_sentences: int, least_words: int) -> tuple[np.ndarray, ...]:
        """(text, first sentence, end, hash, second hash) of the span from each sentence that has one."""
        piece = np.arange(len(self.first))
        end = np.maximum(piece + least_sentences - 1, np.searchsorted(self.last, self.first + least_words - 1))
        ok = end < len(piece)
        ok[ok] = self.owner[end[ok]] == self.owner[ok]
        piece, end = piece[ok], end[ok]
        words = (mix(self.hashes * lane + self.cut.astype(np.uint64)) for lane in _LANES)  # where sentences end counts too
        h1, h2 = (run_hashes(w, self.first[piece], self.last[end] + 1).view(np.int64) for w in words)
        start = self.begin[self.owner[piece]]
        return self.owner[piece], piece - start, end - start + 1, h1, h2


def sentences(text: bytes, window: int = 8) -> list[tuple[bytes, list[bytes]]]:
    """(the piece as it stands, its words); the pieces make up the text."""
    found = Pieces([text], window)
    if not len(found.first):
        return [(text, [])] if text else []
    edges = [0, *found.starts[found.first[1:]].tolist(), len(text)]
    return [(text[a:b], text[a:b].lower().split()) for a, b in zip(edges, edges[1:], strict=False)]


def sentence_counts(texts: list[bytes | None], window: int = 8) -> list[int]:
    """How many pieces each text has; a text of white space is one, an empty or null one none."""
    out: list[int] = []
    for begin, end in groups(texts):
        part = texts[begin:end]
        out += [int(n) or int(bool(t)) for t, n in zip(part, Pieces(part, window).counts(), strict=True)]
    return out


def span_rows(docs: DataFrame, least_sentences: int, least_words: int, window: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(h1, h2, doc_id, text_key, first, end) of every span of ``docs`` (doc_id, text), or of those whose h1 may be in the bitmap ``wanted``."""
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)
    schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("h1", "h2")]
        + [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField("text_key", T.LongType())]
        + [T.StructField(c, T.IntegerType()) for c in ("first", "end")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for begin, stop in groups(texts):
                part = texts[begin:stop]
                text, first, end, h1, h2 = Pieces(part, window).spans(least_sentences, least_words)
                if shared is not None:
                    may = in_bitmap(shared.value, h1)
                    text, first, end, h1, h2 = (x[may] for x in (text, first, end, h1, h2))
                if len(text):
                    used, place = np.unique(text, return_inverse=True)
                    keys = text_keys([part[i] for i in used])[place]
                    ids = batch.column(0).take(pa.array(begin + text))
                    numbers = [pa.array(x, kind) for x, kind in ((h1, pa.int64()), (h2, pa.int64()), (keys, pa.int64()), (first, pa.int32()), (end, pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*numbers[:2], ids, *numbers[2:]], names=schema.names)

    return docs.where("doc_id IS NOT NULL").mapInArrow(tidied(run), schema)


def covered(docs: DataFrame, *, least_sentences: int = 2, least_words: int = 20, window: int = 8) -> DataFrame:
    """(doc_id, text_key, gone, first_docs) of each document with a repeated span: ranges of sentences to remove, and the documents where they stand first.

    Spans are counted before they are shuffled, so a span in a third of the documents sends one row for each task. Which
    hashes repeat is stored, and a bitmap of fixed greatest size tells most other spans apart before they are shuffled for the join
    back; there a hot span is a skewed side, which Spark splits.
    """
    place = F.struct("doc_id", "text_key", "first")
    counted = span_rows(docs, least_sentences, least_words, window).groupBy("h1", "h2").agg(F.min(place).alias("lead"), F.count("*").alias("n"))
    lead = stored(counted.where("n > 1").select("h1", "h2", "lead"), "repeated-spans")
    rows = span_rows(docs, least_sentences, least_words, window, bitmap(lead, "h1"))
    again = rows.join(lead, ["h1", "h2"]).where(place != F.col("lead"))
    return again.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "end")).alias("gone"), F.sort_array(F.collect_set("lead.doc_id")).alias("first_docs"))


def _cut(text: bytes, gone: list[dict], window: int) -> tuple[str, int]:
    drop = {i for g in gone for i in range(g["first"], g["end"])}
    return b"".join(p for i, (p, _) in enumerate(sentences(text, window)) if i not in drop).decode(errors="replace"), len(drop)


def rewritten(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns of ``docs``, with clean text, n_sentences, n_removed and first_docs appended (the mapping says under which names)."""
    window = how.get("window", 8)
    key, gid = fresh(docs, "span_text_key"), fresh(docs, "span_doc_id")
    names = {c: fresh(docs, f"span_{c}") for c in ("text", "n_sentences", "n_removed", "first_docs", "gone")}
    lead = stored(covered(pick(docs, id_col, text_col), **how), "spans")
    lead = lead.select(F.col("doc_id").alias(gid), F.col("text_key").alias(key), F.col("gone").alias(names["gone"]), F.col("first_docs").alias(names["first_docs"]))
    some, rest = joined_by_text(docs, lead, id_col, text_col, gid, key, names["n_sentences"], lambda texts: sentence_counts(texts, window))

    def start():
        def work(texts: pa.Array, gone: pa.Array):
            done = [_cut(t, g, window) if g else (None if t is None else t.decode(errors="replace"), 0) for t, g in zip(as_bytes(texts), gone.to_pylist(), strict=True)]
            return [[d[k] for d in done] for k in range(2)]

        return work

    fields = T.StructType([T.StructField(names["text"], T.StringType()), T.StructField(names["n_removed"], T.LongType())])
    cut = with_columns(some, [text_col, names["gone"]], start, fields).drop(names["gone"])
    kind = cut.schema[names["first_docs"]].dataType
    as_it_was = rest.withColumns({names["first_docs"]: F.lit(None).cast(kind), names["text"]: F.col(text_col), names["n_removed"]: F.lit(0).cast("bigint")})
    return cut.unionByName(as_it_was), names


def dedup_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row for each document: doc_id, text, n_sentences, n_removed, first_docs (null if nothing was removed)."""
    out, names = rewritten(pick(docs, id_col, text_col), **how)
    return out.select("doc_id", *(F.col(names[c]).alias(c) for c in ("text", "n_sentences", "n_removed", "first_docs")))
