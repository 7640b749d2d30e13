"""Quality rules: counts of each text, and perplexity under an n-gram model of the corpus.

Words stand between ASCII white space. A text fails the base rules with fewer than ``least_words`` words, or when
more than ``most_repeat`` percent of its words lie in windows of eight words found twice or more.

The model is an interpolated modified Kneser-Ney model of order four over the letters of words, in two factors. Each byte
has one of 64 symbols (letters in one case, digits, kinds of punctuation, classes of other bytes), and a word
is read with its edges: the first factor is the chance of a symbol after three symbols. The second is the chance of the very byte among
those of its symbol, after the two bytes before it, so that no two bytes are alike to the model in any script or case; together they are
the chance of the text's bytes. The model thus has at most 64**4 n-grams of symbols and 256**3 of bytes however large the corpus is. All words of
all different texts are counted on Spark, as a text in many copies would else look too predictable; discounts come from the counts of counts. Probabilities of the seen n-grams of
the highest order stand in arrays sorted by hash; the hash is one-to-one, so a look-up is exact. Lower orders fit
dense tables.

For each language (the label column; a null label is a language of its own) the quartiles of the log-perplexity
over its different texts give a lower and an upper band ``reach`` quartile ranges out: copies of a text count once, near
copies each. A range below the usual range of a language is averaged with it, which weighs as much as ``least_docs``
texts, and quartiles are uncertain by about a range over the root of its number of texts; the bands lie ``errors``
times that further out. A language of few texts thus has wide bands of its own, which narrow as it grows; the only text of a
language cannot fail them. Outside the bands by more than ``errors`` standard errors
of the text's own mean, a document is rejected: short texts have more room, as their mean is less certain.

Null and wordless texts count nothing and fail the base rules. Repeated rows get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import Vocabulary, as_bytes, bitmap, fresh, groups, in_bitmap, stored, tidied, with_columns

ORDER, WIDTH = 4, 6
SYMBOLS = 1 << WIDTH
_HASH = np.uint64(0x9E3779B1)  # odd, so that multiplying by it modulo 2**32 is one-to-one
_WINDOW = 8
_WORDS, _MOST_WORDS = 1 << 14, 100_000  # different words worked out at a time, and held by a task
_SIGNS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"


def _symbol(b: int) -> int:
    c = bytes([b]).lower()
    if b >= 128:
        return 38 + b % 24
    if c.isalpha():
        return 1 + c[0] - 97
    if c.isdigit():
        return 27
    for k, kind in enumerate((b".", b",", b"'", b"-", b"()[]{}", b"\"`", b"!?", b":;", _SIGNS)):
        if c in kind:
            return 28 + k
    return 62 if b < 32 or b == 127 else 37


_FOLD = bytes(_symbol(b) for b in range(256))
_SYMBOL_OF = np.frombuffer(_FOLD, np.uint8).astype(np.int64)
_SPELLED = 1 << WIDTH * ORDER  # codes of three bytes stand from here on, after those of symbols
_GAP = b"  "  # before a word: no word has a space


# Model ------------------------------------------------------------------------------------------


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code, word index) of the n-gram that ends at each symbol of each word and at its edge."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    edge = bytes(ORDER - 1)
    s = np.frombuffer(edge + edge.join(w.translate(_FOLD) for w in words) + edge, np.uint8).astype(np.int64)
    codes = np.zeros(len(s) - ORDER + 1, np.int64)
    for k in range(ORDER):
        codes = codes << WIDTH | s[k : k + len(codes)]
    ends = s[ORDER - 1 :]
    read = (ends != 0) | (s[ORDER - 2 : -1] != 0)
    return codes[read], np.repeat(np.arange(len(words)), lengths + 1)


def spellings(words: list[bytes]) -> np.ndarray:
    """The code of each byte of each word with the two bytes before it: three bytes in a number."""
    s = np.frombuffer(_GAP + _GAP.join(words) if words else b"", np.uint8).astype(np.int64)
    at = np.flatnonzero(s != _GAP[0])
    return s[at - 2] << 16 | s[at - 1] << 8 | s[at]


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(codes, return_inverse=True)
    return unique, np.bincount(place, weights=counts, minlength=len(unique)).astype(np.int64)


def count_ngrams(docs: DataFrame, text_col: str) -> DataFrame:
    """(code, count) over the words of all different texts, of symbols and (from ``_SPELLED`` on) of bytes; each task sends one row for each code it has seen.

    Texts that stand more than once are told from most others by a bitmap of hashes. They alone are shuffled, once for each task.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").select("text", F.xxhash64("text").alias("key"))
    copied = stored(texts.groupBy("key").count().where("count > 1").select("key"), "copied-texts")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(copied, "key"))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(b.filter(pa.array(~in_bitmap(bits.value, b.column(1).to_numpy()))) for b in batches)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(1).to_numpy()
            own = np.flatnonzero(in_bitmap(bits.value, keys))
            new = [i for i, k in zip(own.tolist(), keys[own].tolist(), strict=True) if not (k in seen or seen.add(k))]
            yield batch.take(pa.array(new, pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = Vocabulary(_MOST_WORDS)
        tally = np.zeros(0, np.int64)

        def flushed() -> tuple[np.ndarray, np.ndarray]:
            all_codes, all_counts = [codes], [counts]
            for k in range(0, len(tally), _WORDS):
                words, times = seen.words[k : k + _WORDS], tally[k : k + _WORDS]
                code, word = ngrams(words)
                spelled = np.repeat(times, np.fromiter(map(len, words), np.int64, len(words)))
                for more in (_summed(code, times[word]), _summed(_SPELLED + spellings(words), spelled)):
                    for kept, part in zip((all_codes, all_counts), more, strict=True):
                        kept.append(part)
            return _summed(np.concatenate(all_codes), np.concatenate(all_counts))

        for batch in batches:
            texts = as_bytes(batch.column(0))
            for begin, end in groups(texts):  # a bounded number of words at a time
                ids = seen.ids([w for t in texts[begin:end] if t for w in t.split()])
                more = np.bincount(ids, minlength=len(seen.words))
                more[: len(tally)] += tally
                tally = more
                if len(seen.words) > seen.most:
                    codes, counts = flushed()
                    seen.trim()
                    tally = np.zeros(0, np.int64)
        codes, counts = flushed()
        yield pa.RecordBatch.from_pydict({"code": pa.array(codes), "count": pa.array(counts)})

    once = texts.mapInArrow(tidied(repeated), texts.schema).groupBy("key").agg(F.first("text").alias("text")).select("text")
    rows = texts.mapInArrow(tidied(single), "code bigint, count bigint").unionAll(once.mapInArrow(tidied(run), "code bigint, count bigint"))
    return rows.groupBy("code").agg(F.sum("count").alias("count"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """The discount of a count of 0, 1, 2, and 3 or more."""
    n1, n2, n3, n4 = (float((counts == k).sum()) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))])


class Spelling:
    """log10 probabilities of bytes among those of their symbol, after up to two bytes: interpolated as the symbols are."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        pairs, pair_counts = np.unique(codes & 0xFFFF, return_counts=True)  # lower orders count the different bytes before
        singles, single_counts = np.unique(pairs & 0xFF, return_counts=True)
        every = np.arange(1 << 16)
        lower = 1 / np.bincount(_SYMBOL_OF, minlength=SYMBOLS)[_SYMBOL_OF]  # below order one: every byte of the symbol alike
        for seen, times, n in ((singles, single_counts, 8), (pairs, pair_counts, 16)):
            own, left_over = self._order(seen, times, lower, n - 8)
            wide = every[: 1 << n]
            lower = left_over[self._head(wide)] * lower[wide & ((1 << max(n - 8, 8)) - 1)]
            lower[seen] = own
        self.lower = lower  # dense: two bytes
        top, left_over = self._order(codes, counts, lower, 16)
        self.left_over = left_over.astype(np.float32)
        self.codes, self.seen = codes.astype(np.uint32), np.log10(top).astype(np.float32)

    @staticmethod
    def _head(codes: np.ndarray) -> np.ndarray:
        """The bytes before and the symbol."""
        return codes >> 8 << WIDTH | _SYMBOL_OF[codes & 0xFF]

    @classmethod
    def _order(cls, codes: np.ndarray, counts: np.ndarray, lower: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
        off = _discounts(counts)[np.minimum(counts, 3)]
        heads, contexts = cls._head(codes), 1 << before + WIDTH
        total = np.bincount(heads, weights=counts, minlength=contexts)
        left_over = np.where(total > 0, np.bincount(heads, weights=off, minlength=contexts) / np.maximum(total, 1), 1.0)
        return (counts - off) / total[heads] + left_over[heads] * lower[codes & ((1 << max(before, 8)) - 1)], left_over

    def log10(self, codes: np.ndarray) -> np.ndarray:
        out = np.log10(self.left_over[self._head(codes)] * self.lower[codes & 0xFFFF])
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, codes.astype(np.uint32)), len(self.codes) - 1)
            out = np.where(self.codes[at] == codes, self.seen[at], out)
        return out


class Model:
    """log10 probabilities of symbols after up to three symbols, and of the bytes of symbols (``spelling``)."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        cut = np.searchsorted(codes, _SPELLED)
        self.spelling = Spelling(codes[cut:] - _SPELLED, counts[cut:])
        codes, counts = codes[:cut], counts[:cut]
        by_order = {ORDER: (codes, counts)}
        for n in range(ORDER - 1, 0, -1):  # lower orders count the different symbols before an n-gram
            kept = by_order[n + 1][0] & ((1 << WIDTH * n) - 1)
            by_order[n] = np.unique(kept, return_counts=True)
        lower = np.full(SYMBOLS, 1 / SYMBOLS)  # below order one: every symbol alike
        for n in range(1, ORDER):
            lower, _, _ = self._order(n, *by_order[n], lower)
        self.lower = lower  # dense: three symbols
        top, self.left_over, _ = self._order(ORDER, codes, counts, lower, dense=False)
        hashes = self._hash(codes)
        order = np.argsort(hashes)
        self.hashes, self.seen = hashes[order], np.log10(top[order]).astype(np.float32)

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * _HASH & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    @staticmethod
    def _order(n: int, codes: np.ndarray, counts: np.ndarray, lower: np.ndarray, dense: bool = True):
        d = _discounts(counts)
        off = d[np.minimum(counts, 3)]
        heads, contexts = codes >> WIDTH, 1 << WIDTH * (n - 1)
        total = np.bincount(heads, weights=counts, minlength=contexts)
        saved = np.bincount(heads, weights=off, minlength=contexts)
        left_over = np.where(total > 0, saved / np.maximum(total, 1), 1.0)
        tail = codes & ((1 << WIDTH * max(n - 1, 1)) - 1)
        own = (counts - off) / total[heads] + left_over[heads] * lower[tail]
        if not dense:
            return own, left_over, d
        every = np.arange(1 << WIDTH * n)
        out = left_over[every >> WIDTH] * lower[every & ((1 << WIDTH * max(n - 1, 1)) - 1)]
        out[codes] = own
        return out, left_over, d

    def log10(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(codes), -np.log10(SYMBOLS))
        hashes = self._hash(codes)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        missing = np.log10(self.left_over[codes >> WIDTH] * self.lower[codes & ((1 << WIDTH * (ORDER - 1)) - 1)])
        return np.where(self.hashes[at] == hashes, self.seen[at], missing)

    def of_words(self, words: list[bytes], spelled: bool = False) -> np.ndarray:
        """[word, (sum of log10, sum of squares, symbols)], of the symbols alone or with their bytes."""
        out = np.zeros((len(words), 3))
        for k in range(0, len(words), _WORDS):
            part = words[k : k + _WORDS]
            codes, word = ngrams(part)
            p = self.log10(codes)
            if spelled:
                p[(codes & (SYMBOLS - 1)) != 0] += self.spelling.log10(spellings(part))
            out[k : k + len(part)] = np.stack([np.bincount(word, weights=x, minlength=len(part)) for x in (p, p * p, np.ones(len(p)))], 1)
        return out


def learn(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts. At most 64**4 + 256**3 rows reach the driver, at any size of the corpus."""
    table = count_ngrams(docs, text_col).toArrow()
    codes, counts = table.column("code").to_numpy(), table.column("count").to_numpy()
    order = np.argsort(codes)
    return Model(codes[order], counts[order])


# Counts of a text -------------------------------------------------------------------------------

_WEIGHTS = np.random.default_rng(7).integers(1, 1 << 63, _WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(ids: np.ndarray) -> int:
    """Words in windows of eight that are found twice or more; windows with equal hashes are compared word for word."""
    n = len(ids) - _WINDOW + 1
    if n < 2:
        return 0
    hashes = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(_WINDOW):
            hashes += ids[k : k + n].astype(np.uint64) * _WEIGHTS[k]
    ranked = np.sort(hashes)
    if not (ranked[1:] == ranked[:-1]).any():
        return 0
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    a, b = order[:-1][same], order[1:][same]
    if not all((ids[a + k] == ids[b + k]).all() for k in range(_WINDOW)):
        _, place, times = np.unique(np.lib.stride_tricks.sliding_window_view(ids, _WINDOW), axis=0, return_inverse=True, return_counts=True)
        a = b = np.flatnonzero(times[place.ravel()] > 1)
    steps = np.zeros(len(ids) + 1, np.int64)
    twice = np.unique(np.concatenate([a, b]))
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + _WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


_ASCII_AND_LEADS = bytes(b for b in range(256) if b & 0xC0 != 0x80)


def counts_of(text: bytes, ids: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += bool(line.strip(_SPACE))
        seen.add(line)
    chars = len(text.translate(None, _SPACE)) - len(text.translate(None, _ASCII_AND_LEADS))
    return chars, len(text) - len(text.translate(None, _SIGNS)), dup, repeated_words(ids)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log10_prob", "square", "symbols")
_FIELDS = [T.StructField(c, T.DoubleType() if c in ("log10_prob", "square") else T.LongType()) for c in MEASURES]


def measured(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the measures of each text appended; the second value maps a measure to its column."""
    names = {c: fresh(docs, f"quality_{c}") for c in MEASURES}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model, known = shared.value, Vocabulary(_MOST_WORDS)

        def work(column: pa.Array):
            texts, measures = as_bytes(column), []
            for begin, end in groups(texts):  # so that the words of a whole batch are never held together
                known.trim()
                rows = []
                for text in texts[begin:end]:
                    text = text or b""
                    ids = known.ids(text.split())
                    rows.append((ids, *counts_of(text, ids)))
                scores = known.scored(lambda words: model.of_words(words, spelled=True))
                for ids, *counts in rows:
                    p, square, symbols = scores[ids].sum(0)
                    measures.append((len(ids), *counts, float(p), float(square), int(symbols)))
            return [list(c) for c in zip(*measures, strict=True)] or [[] for _ in MEASURES]

        return work

    fields = T.StructType([T.StructField(names[f.name], f.dataType) for f in _FIELDS])
    return with_columns(docs, [text_col], start, fields), names


# Verdicts ---------------------------------------------------------------------------------------


def bands(marks: DataFrame, label: str, key: str, *, reach: float = 2.0, errors: float = 3.0, least_docs: int = 50) -> DataFrame:
    """(label, low, high): the bands of the log-perplexity of each language, from ``marks`` (label, key of the text, x)."""
    texts = marks.groupBy(label, key).agg(F.min("x").alias("x"))
    quartiles = F.percentile_approx("x", [0.25, 0.75], 10_000).alias("q")
    own = stored(texts.groupBy(label).agg(F.count("x").alias("n"), quartiles), "quartiles")
    n, across = F.col("n"), F.col("q")[1] - F.col("q")[0]
    weight = n / (n + least_docs)  # no language counts for more than one, however many texts it has
    usual = own.agg(F.try_divide(F.sum(weight * across), F.sum(weight)).alias("usual")).first()["usual"] or 0.0
    width = across + (1 - weight) * F.greatest(F.lit(usual) - across, F.lit(0.0))
    room = width * (reach + errors / F.sqrt("n"))
    return own.select(label, (F.col("q")[0] - room).alias("low"), (F.col("q")[1] + room).alias("high"))


def _log_perplexity(names: dict[str, str]) -> Column:
    return F.try_divide(-F.col(names["log10_prob"]), F.col(names["symbols"]))


def _base_failed(names: dict[str, str], least_words: int, most_repeat: int) -> Column:
    words = F.col(names["n_words"])
    return (words < least_words) | (100 * F.col(names["n_repeat_words"]) > most_repeat * words)


def _within(names: dict[str, str], errors: float, low: str = "low", high: str = "high") -> Column:
    n, x = F.col(names["symbols"]), _log_perplexity(names)
    room = errors * F.sqrt(F.try_divide(F.greatest(F.try_divide(F.col(names["square"]), n) - x * x, F.lit(0.0)), n))
    return (x >= F.col(low) - room) & (x <= F.col(high) + room)


def _judged(marks: DataFrame, names: dict[str, str], least_words: int, most_repeat: int, reach: float, errors: float, least_docs: int) -> DataFrame:
    """``marks`` (label, key of the text, measures) with base_failed and kept."""
    own = marks.where(F.col(names["symbols"]) > 0).select("label", "key", _log_perplexity(names).alias("x"))
    edge = bands(own, "label", "key", reach=reach, errors=errors, least_docs=least_docs).withColumnRenamed("label", "band_label")
    failed = _base_failed(names, least_words, most_repeat)
    judged = marks.join(edge, marks["label"].eqNullSafe(F.col("band_label")), "left")
    return judged.withColumns({"base_failed": failed, "kept": ~failed & F.coalesce(_within(names, errors), F.lit(False))})


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", least_words: int = 20, most_repeat: int = 30, reach: float = 2.0, errors: float = 3.0, least_docs: int = 50) -> DataFrame:
    """One row for each document: doc_id, the five counts, log10_prob, symbols, base_failed, kept."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text"))
    with_measures, names = measured(chosen, learn(chosen))
    marks = stored(with_measures.withColumn("key", F.xxhash64("text")).drop("text"), "quality")
    judged = _judged(marks, names, least_words, most_repeat, reach, errors, least_docs)
    return judged.select("doc_id", *(F.col(names[c]).alias(c) for c in MEASURES if c != "square"), "base_failed", "kept")


def without_poor(docs: DataFrame, *, text_col: str = "text", label_col: str = "lang", least_words: int = 20, most_repeat: int = 30, reach: float = 2.0, errors: float = 3.0, least_docs: int = 50) -> DataFrame:
    """The documents that are kept, with all their columns.

    Measures are stored without the texts. The verdict follows from text and label, so the rejected pairs of both are told by a hash;
    a bitmap passes on most documents, and only what it lets through is shuffled to be compared with them.
    """
    label, text = F.col(label_col).cast("string"), F.col(text_col).cast("string")
    chosen = docs.select(label.alias("label"), text.alias("text"))
    with_measures, names = measured(chosen, learn(chosen))
    marks = stored(with_measures.withColumns({"key": F.xxhash64("text"), "pair": _pair(F.col("text"), F.col("label"))}).drop("text"), "quality")
    poor = stored(_judged(marks, names, least_words, most_repeat, reach, errors, least_docs).where("NOT kept").select("pair").distinct(), "rejected")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(poor, "pair"))
    may_be_poor = F.pandas_udf(lambda pairs: pd.Series(in_bitmap(bits.value, pairs.to_numpy())), "boolean")
    own, may = fresh(docs, "own_pair"), fresh(docs, "may_be_poor")
    told = docs.withColumn(own, _pair(text, label)).withColumn(may, may_be_poor(F.col(own)))
    some = told.where(F.col(may)).join(poor.withColumnRenamed("pair", own), own, "left_anti")
    return told.where(~F.col(may)).select(*docs.columns).unionAll(some.select(*docs.columns))


def _pair(text: Column, label: Column) -> Column:
    """A hash of text and label; a null is none of the strings."""
    return F.xxhash64(text, text.isNull(), label, label.isNull())
