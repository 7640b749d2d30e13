"""Toxicity with a convolutional network over hashed word embeddings.

Words are runs of ASCII letters, digits and characters from U+0080 on, in lower case. A word's vector is the sum of the embeddings of the
buckets that the word itself, its beginnings of 4 to 6 and its endings of 4 and 5 bytes fall into, so that unseen forms of a known stem have a vector too. Filters
of several widths slide over the whole text; each keeps its largest value, and a logistic layer reads those. Training is numpy:
cross entropy, balanced batches, back-propagation through the windows that gave the largest values, Adam for the filters and Adagrad for
the buckets that a batch meets.

Thresholds are calibrated by language on labelled texts that the network has not seen: for each language the cut with the best balanced accuracy,
drawn towards the cut of all languages where there are few texts. The language of a text is guessed from its words (counts of hashed words
for each language, learned from the training rows), since no column but the text may enter a score. ``score`` is the logistic function of the
distance to the threshold, so that 0.5 is the calibrated cut in every language.

All labelled texts are learned from, equal texts with equal labels once: a quarter of them, by a hash, sets the thresholds, the others teach the network and
the languages. The network begins on the driver with a start of bounded size (``sample_docs`` texts of each label, chosen by a hash of their id, of at most
``sample_bytes`` together); then every task goes through all its own texts from there (a small corpus up to eight times), and the mean of what the tasks have learned is taken, for each
bucket by how often a task met it. Each language's thresholds come from the counts of all held back texts on a grid of 1/1024 of a logit. A text is read whole,
however long, in pieces that overlap by a window.

A null text is an empty one; a text without words has the score of the empty window. Without labelled rows of both labels every score is the share of label 1 among
them, 0 without any. Labels other than 0 and 1 are ignored, labels of unknown ids too; a row counts once for each of its labels.
Scores are rounded to six places, so that equal texts score alike in any batch; an empty table gives no rows.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import Vocabulary, fresh, mixed, stored, sum_of, tidied, with_columns

BEGINNINGS, ENDINGS = (4, 5, 6), (4, 5)
BLANK = b""  # no text has this word
FEATURES = 1 + len(BEGINNINGS) + len(ENDINGS)
GRID, FARTHEST = 1024, 64  # steps in a logit, and the farthest cut
_SPACED = bytes(c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in range(256))


def words_of(texts: pa.Array) -> Iterator[list[bytes]]:
    """The words of each text, one text at a time; a null has none."""
    for t in pc.utf8_lower(texts.cast(pa.large_string())).cast(pa.large_binary()):
        whole = t.as_py()
        yield whole.translate(_SPACED).split() if whole else []


def ends_of(texts: pa.Array, most: int = 4_000_000) -> Iterator[int]:
    """Where to cut ``texts`` into neighbours of about ``most`` bytes together."""
    size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1):
        size += n
        if size >= most or i == len(texts):
            yield i
            size = 0


def buckets_of(words: list[bytes], bits: int) -> np.ndarray:
    """[word, feature] buckets; a beginning or an ending that is the whole word is the bucket of the word."""
    mask, hash_ = (1 << bits) - 1, xxhash.xxh3_64_intdigest
    out = np.empty((len(words), FEATURES), np.int32)
    for i, w in enumerate(words):
        own, n = hash_(w) & mask, len(w)
        out[i] = (
            own,
            *[hash_(w[:k], 1) & mask if n > k else own for k in BEGINNINGS],
            *[hash_(w[-k:], 2) & mask if n > k else own for k in ENDINGS],
        )
    return out


class Network:
    """Bucket embeddings, filters of several widths and the layer that reads their largest values."""

    def __init__(self, *, bits: int = 18, embed: int = 8, filters: int = 16, widths: tuple[int, ...] = (1, 2, 3), seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bits, self.widths, self.filters, self.embed = bits, widths, filters, embed
        self.e = (rng.standard_normal((1 << bits, embed)) * 0.05).astype(np.float32)
        self.p = {f"W{w}": (rng.standard_normal((w * embed, filters)) / np.sqrt(w * embed)).astype(np.float32) for w in widths}
        self.p |= {f"b{w}": np.zeros(filters, np.float32) for w in widths}
        self.p["v"] = (rng.standard_normal(filters * len(widths)) * 0.3).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    @property
    def pad(self) -> int:
        return max(self.widths) - 1

    def vectors(self, buckets: np.ndarray) -> np.ndarray:
        return self.e[buckets].sum(1)

    def parts(self, vectors: np.ndarray) -> np.ndarray:
        """[word, what it adds to every filter at every place of the window]; widths one after the other."""
        d = self.embed
        return vectors @ np.concatenate([self.p[f"W{w}"][j * d : (j + 1) * d] for w in self.widths for j in range(w)], 1)

    def slid(self, parts: np.ndarray) -> np.ndarray:
        """[start, filter] values of the windows; the last ``pad`` words start none."""
        n, f, out, at = len(parts) - self.pad, self.filters, [], 0
        for w in self.widths:
            value = parts[:n, at : at + f] + self.p[f"b{w}"]
            for j in range(1, w):
                value += parts[j : n + j, at + j * f : at + (j + 1) * f]
            at += w * f
            out.append(value)
        return np.concatenate(out, 1)

    def logits(self, largest: np.ndarray) -> np.ndarray:
        return np.maximum(largest, 0) @ self.p["v"] + self.p["c"][0]

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray | float = 1.0) -> tuple[float, dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Mean loss, gradients of the layers, and buckets with the gradient of each; ``texts`` are [word, feature] buckets, which count by their ``weights``."""
        d, f, pad = self.embed, self.filters, self.pad
        empty = np.zeros((pad, d), np.float32)
        inside = [np.concatenate([self.vectors(t) if len(t) else empty[:1], empty]) for t in texts]
        at, largest = [], []
        for x in inside:
            values = self.slid(self.parts(x))
            at.append(values.argmax(0))
            largest.append(values.max(0))
        at, largest = np.array(at), np.array(largest)
        logits = self.logits(largest)
        probs = 1 / (1 + np.exp(-logits))
        loss = float(np.mean(weights * (np.logaddexp(0, logits) - labels * logits)))
        d_logit = (weights * (probs - labels) / len(texts)).astype(np.float32)
        g = {"v": np.maximum(largest, 0).T @ d_logit, "c": np.array([d_logit.sum()], np.float32)}
        d_value = d_logit[:, None] * self.p["v"] * (largest > 0)
        starts = np.cumsum([0, *[len(x) for x in inside]])[:-1]
        flat = np.concatenate(inside)
        d_flat = np.zeros_like(flat)
        for k, w in enumerate(self.widths):
            own = d_value[:, k * f : (k + 1) * f]
            place = starts[:, None] + at[:, k * f : (k + 1) * f]
            g[f"b{w}"] = own.sum(0)
            weight = self.p[f"W{w}"].reshape(w, d, f)
            g[f"W{w}"] = np.concatenate([np.einsum("tfd,tf->df", flat[place + j], own) for j in range(w)])
            for j in range(w):
                np.add.at(d_flat, place + j, own[:, :, None] * weight[j].T)
        hit = [np.flatnonzero(d_flat[s : s + len(t)].any(1)) for s, t in zip(starts, texts, strict=True)]
        buckets = np.concatenate([t[h] for t, h in zip(texts, hit, strict=True)])
        each = np.concatenate([d_flat[s + h] for s, h in zip(starts, hit, strict=True)])
        found, back = np.unique(buckets, return_inverse=True)
        d_buckets = np.zeros((len(found), d), np.float32)
        np.add.at(d_buckets, back.reshape(buckets.shape), each[:, None, :])
        return loss, g, found, d_buckets


class Descent:
    """Adam for the layers of a network and Adagrad for its buckets."""

    def __init__(self, net: Network, rate: float = 0.004, embed_rate: float = 0.08):
        self.net, self.rate, self.embed_rate, self.steps = net, rate, embed_rate, 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
        self.squares = np.full(len(net.e), 1e-4, np.float32)

    def step(self, texts: list[np.ndarray], labels: np.ndarray, pace: float, weights: np.ndarray | float = 1.0) -> np.ndarray:
        """One step; returns the buckets that were met."""
        net = self.net
        self.steps += 1
        _, grads, found, d_buckets = net.gradients(texts, labels, weights)
        self.squares[found] += (d_buckets**2).mean(1)
        net.e[found] -= self.embed_rate * pace * d_buckets / np.sqrt(self.squares[found])[:, None]
        for k, g in grads.items():
            self.first[k] = 0.9 * self.first[k] + 0.1 * g
            self.second[k] = 0.999 * self.second[k] + 0.001 * g * g
            move = self.first[k] / (1 - 0.9**self.steps) / (np.sqrt(self.second[k] / (1 - 0.999**self.steps)) + 1e-7)
            net.p[k] -= (self.rate * pace * move).astype(np.float32)
        return found


LAST_PACE, MOST_PASSES = 0.2, 8


def train(texts: list[np.ndarray], labels: np.ndarray, langs: list[str | None], *, steps: int = 2000, batch: int = 32, rate: float = 0.004, embed_rate: float = 0.08, seed: int = 1, **shape) -> Descent:
    """``texts`` are [word, feature] buckets; both labels occur. Labels are drawn equally often and, within each, languages more evenly than they occur."""
    rng = np.random.default_rng(seed)
    descent = Descent(Network(seed=seed, **shape), rate, embed_rate)
    sides = [np.flatnonzero(labels == 0), np.flatnonzero(labels == 1)]
    _, lang = np.unique([x or "" for x in langs], return_inverse=True)
    chance = [1 / np.sqrt(np.bincount(lang[s])[lang[s]]) for s in sides]
    for step in range(1, steps + 1):
        drawn = np.concatenate([rng.choice(s, batch // 2, p=c / c.sum()) for s, c in zip(sides, chance, strict=True)])
        descent.step([texts[i] for i in drawn], labels[drawn], min(1.0, 1 + LAST_PACE - step / steps))
    return descent


def trained_on_all(rows: DataFrame, start: Descent, weights: dict[tuple[str | None, int], float], *, passes: int = 1, batch: int = 32) -> Network:
    """The network after every task has gone through its own ``rows`` (text, lang, label) from ``start``, ``passes`` times through each batch; ``weights`` are by language and label."""
    shared = rows.sparkSession.sparkContext.broadcast((start, weights))
    layers = sum(v.size for v in start.net.p.values())
    width, buckets = start.net.embed, len(start.net.e)

    def matrix(net: Network) -> np.ndarray:
        flat = np.concatenate([v.ravel() for v in net.p.values()])
        return np.concatenate([net.e, np.resize(np.concatenate([flat, np.zeros(-len(flat) % width)]), (-(-layers // width), width))]).astype(np.float64)

    def work(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        first, weights = shared.value
        descent, known, met = copy.deepcopy(first), Vocabulary(60_000), np.zeros(buckets)
        rng = np.random.default_rng(1)
        for rows in batches:
            at, texts = 0, rows.column(0)
            for end in ends_of(texts):
                known.trim()
                ids = [known.ids(w) for w in words_of(texts[at:end])]
                table = known.scored(lambda words: buckets_of(words, descent.net.bits)) if known.words else np.zeros((0, FEATURES), np.int32)
                labels = rows.column(2)[at:end].to_numpy()
                langs = rows.column(1)[at:end].to_pylist()
                weight = np.array([weights[k] for k in zip(langs, labels.tolist(), strict=True)])
                for own in (o[i : i + batch] for o in (rng.permutation(end - at) for _ in range(passes)) for i in range(0, len(o), batch)):
                    met[descent.step([table[ids[k]] for k in own], labels[own], LAST_PACE, weight[own])] += 1
                at = end
        return matrix(descent.net), np.concatenate([met, np.full(-(-layers // width), descent.steps - first.steps)])

    found = mixed(rows, matrix(start.net), work).astype(np.float32)
    net = copy.deepcopy(start.net)
    net.e, flat, at = found[:buckets], found[buckets:].ravel(), 0
    for k, v in net.p.items():
        net.p[k] = flat[at : at + v.size].reshape(v.shape)
        at += v.size
    return net


class Languages:
    """Guesses the language of a text from hashed words: log-probabilities of each bucket in each language."""

    def __init__(self, names: list[str], table: np.ndarray):
        self.names, self.table = names, table

    @classmethod
    def learned(cls, rows: DataFrame, names: list[str], bits: int = 14) -> Languages:
        """From all ``rows`` (text, lang)."""
        table = np.zeros((1 << bits, max(1, len(names))))
        number = {x: k for k, x in enumerate(names)}

        def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            counts, known = np.zeros(table.shape), Vocabulary(60_000)
            for batch in batches:
                at, texts, langs = 0, batch.column(0), batch.column(1).to_pylist()
                for end in ends_of(texts):
                    known.trim()
                    for words, lang in zip(words_of(texts[at:end]), langs[at:end], strict=True):
                        ids = known.ids(words)
                        own = known.scored(lambda new: np.array([xxhash.xxh3_64_intdigest(w) & ((1 << bits) - 1) for w in new], np.int32)) if known.words else ids
                        np.add.at(counts[:, number[lang]], own[ids], 1.0)
                    at = end
            return counts

        table = sum_of(rows.where("lang IS NOT NULL").select("text", "lang"), work, table) + 0.5
        return cls(names, np.log(table / table.sum(0)).astype(np.float32))

    def of_buckets(self, buckets: np.ndarray) -> np.ndarray:
        return self.table[buckets[:, 0] & (len(self.table) - 1)]


def best_cut(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The cut with the best balanced accuracy, in the middle of its gap; of equally good ones the middle one. Each pair stands for ``counts`` texts."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order] == 1
    times = np.ones(len(x)) if counts is None else counts[order]
    ones, zeros = times * y, times * ~y
    right = np.concatenate([[0], np.cumsum(zeros)]) / max(1, zeros.sum()) + (ones.sum() - np.concatenate([[0], np.cumsum(ones)])) / max(1, ones.sum())
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    ties = np.concatenate([[False], x[1:] == x[:-1], [False]])
    right[ties] = -1
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(edges[best[len(best) // 2]])


class Scorer:
    """A network with its thresholds, or a constant where there was nothing to learn."""

    def __init__(self, constant: float, net: Network | None = None, languages: Languages | None = None, cuts: np.ndarray | None = None):
        self.constant, self.net, self.languages, self.cuts = constant, net, languages, cuts

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """[word, (parts of the filters, log-probabilities of the languages)]; zeros for the blank behind a text."""
        out = np.empty((len(words), self.width), np.float32)
        for at in range(0, len(words), 65_536):
            some = words[at : at + 65_536]
            buckets = buckets_of(some, self.net.bits)
            rows = np.concatenate([self.net.parts(self.net.vectors(buckets)), self.languages.of_buckets(buckets)], 1)
            rows[[w == BLANK for w in some]] = 0
            out[at : at + len(some)] = rows
        return out

    @property
    def width(self) -> int:
        return self.net.filters * sum(self.net.widths) + len(self.languages.table[0])

    def read(self, table: np.ndarray, ids: list[np.ndarray], blank: int, *, piece: int = 16_384, most: int = 32_768) -> tuple[np.ndarray, np.ndarray]:
        """Logits and thresholds of texts given as rows of ``table``, in which ``blank`` is all zeros; at most about ``most`` words are spread out at a time."""
        net, k = self.net, len(self.languages.table[0])
        wide = table.shape[1] - k
        largest = np.full((len(ids), len(net.p["v"])), -np.inf, np.float32)
        told = np.zeros((len(ids), k))
        nothing = np.full(net.pad, blank)
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            if not held:
                return
            rows = table[np.concatenate([own for _, own in held])]
            lengths = np.array([len(own) for _, own in held])
            first = np.cumsum(lengths) - lengths
            values = net.slid(rows[:, :wide])
            # windows that start in the last words of a piece reach into the next one
            starts = np.stack([first, first + lengths - net.pad], 1).ravel()
            tops = np.maximum.reduceat(np.concatenate([values, values[-1:]]), starts[:-1] if starts[-1] >= len(values) else starts)[::2]
            np.maximum.at(largest, [i for i, _ in held], tops)
            held.clear()

        for i, own in enumerate(ids):
            if len(own):
                for at in range(0, len(own), piece):
                    told[i] += table[own[at : at + piece], wide:].sum(0)
            padded = np.concatenate([own if len(own) else [blank], nothing])
            for at in range(0, max(1, len(own)), piece):
                part = padded[at : at + piece + net.pad]
                if size + len(part) > most:
                    flush()
                    size = 0
                held.append((i, part))
                size += len(part)
        flush()
        lang = np.where([len(own) > 0 for own in ids], told.argmax(1), -1) if len(ids) else np.zeros(0, int)
        return net.logits(largest), self.cuts[lang]

    def judged(self, texts: pa.Array, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Logits and thresholds of whole texts."""
        ids = [known.ids(w) for w in words_of(texts)]
        blank = int(known.ids([BLANK])[0])
        return self.read(known.scored(self.of_words), ids, blank)

    def scores(self, texts: pa.Array, known: Vocabulary) -> np.ndarray:
        logits, cuts = self.judged(texts, known)
        return np.round(0.5 * (1 + np.tanh(0.5 * (logits.astype(float) - cuts))), 6)


def calibrated(net: Network, languages: Languages, rows: DataFrame, *, pull: int = 40) -> Scorer:
    """Thresholds from all labelled ``rows`` (text, label); that of a language counts ``pull`` texts of the common one with its own. The last is the common one."""
    count = len(languages.table[0])
    scorer = Scorer(0.0, net, languages, np.arange(count + 1.0))  # the cuts are still the numbers of the languages
    shared = rows.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(60_000)
        for batch in batches:
            texts, at = batch.column(0), 0
            for end in ends_of(texts):
                logits, told = shared.value.judged(texts[at:end], known)
                place = np.round(np.clip(logits.astype(float), -FARTHEST, FARTHEST) * GRID).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"told": pa.array(told.astype(np.int32)), "place": pa.array(place), "label": batch.column(1)[at:end]})
                known.trim()
                at = end

    # at most 2 * GRID * FARTHEST places of each language and label
    found = rows.select("text", "label").mapInArrow(tidied(run), "told int, place int, label int").groupBy("told", "place", "label").agg(F.count("*").alias("times"))
    found = stored(found, "places").orderBy("told", "place", "label").toArrow()
    told, place, labels, times = (found.column(c).to_numpy() for c in ("told", "place", "label", "times"))
    logits = place / GRID
    common = best_cut(logits, labels, times) if len(set(labels.tolist())) == 2 else 0.0
    scorer.cuts = np.full(count + 1, common)
    for k in range(count):
        own = told == k
        if len(set(labels[own].tolist())) == 2:
            fewer = 2 * min(times[own & (labels == 1)].sum(), times[own & (labels == 0)].sum())
            scorer.cuts[k] = (fewer * best_cut(logits[own], labels[own], times[own]) + pull * common) / (fewer + pull)
    return scorer


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, key, label, lang): of the rows of ``docs`` (doc_id, text, lang) that share a text and a label (doc_id, label) only the first. ``key`` is the hash of the text."""
    keys = docs.select("doc_id", F.xxhash64("text").alias("key"), "lang").join(labels.where("label IN (0, 1)"), "doc_id")
    return keys.groupBy("key", "label").agg(F.min(F.struct("doc_id", "lang")).alias("first")).select("first.doc_id", "key", "label", "first.lang")


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(text, lang, label) of ``chosen`` rows of ``labelled``, once each."""
    own = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    # both sides are shuffled at any size: the list of rows grows with the corpus, and the plan with it
    rows = own.join(chosen.hint("merge"), ["doc_id", "key"]).groupBy("doc_id", "key", "label").agg(F.first("text").alias("text"), F.first("lang").alias("lang"))
    return rows.select("text", "lang", "label")


def sampled(docs: DataFrame, labels: DataFrame, *, sample_docs: int, sample_bytes: int) -> list[tuple[str, str | None, int]]:
    """(text, lang, label) of the training sample of ``docs`` (doc_id, text, lang) by ``labels`` (doc_id, label); equal texts once."""
    known = labels.where("label IN (0, 1)").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity"))
    chosen = None
    for label in (0, 1):
        side = known.where(F.col("label") == label).orderBy(order, "doc_id").limit(sample_docs)
        chosen = side if chosen is None else chosen.unionByName(side)
    ids = [(r["doc_id"], int(r["label"])) for r in chosen.select("doc_id", "label").collect()]
    if not ids:
        return []
    spark = docs.sparkSession
    wanted = spark.createDataFrame(ids, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("label", T.IntegerType())]))
    rows = docs.join(F.broadcast(wanted), "doc_id").withColumn("size", F.octet_length("text")).dropDuplicates(["doc_id", "label", "text"])  # at most 2 * sample_docs ids
    sizes = rows.select("doc_id", "label", F.xxhash64("text").alias("key"), "size", order.alias("at")).collect()
    left, taken, seen = sample_bytes, [], set()
    for r in sorted(sizes, key=lambda r: (r["at"], r["label"], r["key"])):
        if (r["key"], r["label"]) not in seen and r["size"] <= left:
            seen.add((r["key"], r["label"]))
            left -= r["size"]
            taken.append((r["doc_id"], r["label"], r["key"]))
    schema = T.StructType([*wanted.schema.fields, T.StructField("key", T.LongType())])
    kept = rows.withColumn("key", F.xxhash64("text")).join(F.broadcast(spark.createDataFrame(taken, schema)), ["doc_id", "label", "key"])
    return sorted({(r["text"], r["lang"], r["label"]) for r in kept.select("text", "lang", "label").collect()}, key=lambda r: (r[0], r[1] or "", r[2]))


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic",
          sample_docs: int = 3_000, sample_bytes: int = 24_000_000, **how) -> Scorer:
    """From all rows of ``docs`` that have a label in ``labels``; a quarter of the texts only sets the thresholds. The sample is where the network starts."""
    pairs = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).distinct()
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    chosen = stored(labelled(own, pairs).withColumn("aside", F.pmod("key", F.lit(4)) == 0), "labelled")
    sizes = chosen.groupBy("aside", "lang", "label").count().collect()  # a row for each language
    times = [sum(r["count"] for r in sizes if r["label"] == label) for label in (0, 1)]
    if not all(times):
        return Scorer(times[1] / max(1, sum(times)))
    both = all({r["label"] for r in sizes if r["aside"] == part} == {0, 1} for part in (True, False))
    fit = chosen.where(~F.col("aside")) if both else chosen  # too few rows to set some aside
    seen = {}
    for r in sizes:
        if not (both and r["aside"]):
            seen[r["lang"], r["label"]] = seen.get((r["lang"], r["label"]), 0) + r["count"]
    place = F.pmod(F.xxhash64("text"), F.lit(4))
    teach, hold = (own.where(place != 0), own.where(place == 0)) if both else (own, own)
    rows = sampled(teach, pairs, sample_docs=sample_docs, sample_bytes=sample_bytes)
    y = np.array([r[2] for r in rows])
    bits = how.get("bits", 18)
    buckets = [buckets_of(w, bits) for r in rows for w in words_of(pa.array([r[0]], pa.large_string()))]
    how = how if len(set(y.tolist())) == 2 else how | {"steps": 0}  # a start that saw one label teaches nothing
    start = train(buckets, y, [r[1] for r in rows], **how)
    # labels count equally and, within each, languages more evenly than they occur
    evenly = {k: 1 / np.sqrt(n) for k, n in seen.items()}
    share = [sum(n * evenly[k] for k, n in seen.items() if k[1] == label) for label in (0, 1)]
    weights = {k: 0.5 * sum(seen.values()) * w / share[k[1]] for k, w in evenly.items()}
    passes = min(MOST_PASSES, max(1, -(-how.get("steps", 2000) * how.get("batch", 32) // sum(seen.values()))))
    net = trained_on_all(texts_of(teach, fit), start, weights, passes=passes)
    languages = Languages.learned(texts_of(teach, fit), sorted({k[0] for k in seen if k[0] is not None}))
    return calibrated(net, languages, texts_of(hold, chosen.where("aside") if both else chosen))


def score(docs: DataFrame, scorer: Scorer, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` appended, longer names where these are taken; nothing but the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    fields = T.StructType([T.StructField(fresh(docs, "score"), T.DoubleType()), T.StructField(fresh(docs, "predicted"), T.IntegerType())])

    def start():
        model, known = shared.value, Vocabulary(60_000)

        def work(texts: pa.Array):
            found = np.full(len(texts), model.constant)
            if model.net is not None:
                at = 0
                for end in ends_of(texts):
                    found[at:end] = model.scores(texts[at:end], known)
                    known.trim()
                    at = end
            return found.tolist(), (found >= 0.5).astype(int).tolist()

        return work

    return with_columns(docs.withColumn(text_col, F.col(text_col).cast("string")), [text_col], start, fields)
