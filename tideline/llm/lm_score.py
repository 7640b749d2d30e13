"""Scores of texts under two language models: smoothed word counts, and a small causal self-attention network.

Tokens of the base model are words (ASCII letters lower-cased, between ASCII white space), then one end. Training words are counted over
all training documents on Spark. The most frequent words, at most ``head_words`` by a common least count, are broadcast;
the rest of each document's words (with their numbers) are joined to the counts by word. What is counted, joined and summed
thus grows with the corpus, and nothing that grows with it is broadcast.

The network reads subword ids of the same words. Their numbers in all training documents, taken from the word counts, give
classes of near equal mass (ids that start a word and ids that go on with one apart; the end is a class of its own)
and the probability of an id in its class. Attention gives the probability of the next class: windows of ``context``
earlier ids and ``stride`` new ones overlap, so that each id is scored once and sees at least ``context`` ids before it, where its
document has them. A batch of windows is one masked attention; ids of other documents are masked out.

The network learns from every training document. It begins on the driver with a start of bounded size (about ``sample_docs`` documents by a hash, cut into
windows, of which at most ``sample_windows`` are used); then every task goes once through all windows of its own documents from there, equal texts of a task
once, and the mean of what the tasks have learned is taken, for each bucket by how often a task met it. Texts are cut into ids once, when
words are looked up; learning and scoring read the stored ids.

A null text is an empty one and has its end only. Rows are scored one by one, also with equal or null ids. If nothing
is there to learn from, all ids are alike. An empty table gives no rows.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm import subwords
from tideline.llm.common import Vocabulary, as_bytes, groups, mixed, stored, text_keys, tidied

LAST_PACE = 0.1

# Network ----------------------------------------------------------------------------------------


class Attention:
    """One masked self-attention layer over buckets of ids, and a softmax over classes."""

    def __init__(self, buckets: int, classes: int, width: int = 16, context: int = 16, stride: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)

        def weights(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.width, self.context, self.stride = width, context, stride
        span = context + stride
        self.p = {"E": (rng.standard_normal((buckets, width)) * 0.5).astype(np.float32), "Wk": weights(width, width), "Wq": weights(width, width), "Wv": weights(width, width), "far": np.zeros(span, np.float32), "W": weights(2 * width, classes) * 0.3, "b": np.zeros(classes, np.float32)}
        self.gap = np.arange(stride)[:, None] + context - np.arange(span)[None, :]  # how far back a key is from a query

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys and of the queries of each window over ``n`` ids; places outside are below 0 or from ``n`` on."""
        begin = np.arange(0, n, self.stride)[:, None]
        return begin - self.context + np.arange(self.context + self.stride), begin + np.arange(self.stride)

    def forward(self, inputs: np.ndarray, first: np.ndarray, keys: np.ndarray, queries: np.ndarray, tables: dict[str, np.ndarray]):
        """Logits of the next class at each query. ``inputs`` are buckets, ``first`` the place where the document of each begins."""
        last = len(inputs) - 1
        k_at, q_at = np.clip(keys, 0, last), np.minimum(queries, last)
        k_in, q_in = inputs[k_at], inputs[q_at]
        k, v, q = tables["k"][k_in], tables["v"][k_in], tables["q"][q_in]
        scores = q @ k.transpose(0, 2, 1)
        scores += self.p["far"][np.maximum(self.gap, 0)]
        hidden = (self.gap < 0)[None] | (keys[:, None, :] < first[q_at][:, :, None])
        scores[hidden] = -1e9
        scores -= scores.max(2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(2, keepdims=True)
        mixed = np.concatenate([scores @ v, tables["e"][q_in]], 2)
        return mixed @ self.p["W"] + self.p["b"], (k_in, q_in, k, v, q, scores, mixed)

    def tables(self) -> dict[str, np.ndarray]:
        p = self.p
        return {"e": p["E"], "k": p["E"] @ p["Wk"], "q": p["E"] @ p["Wq"] / np.float32(np.sqrt(self.width)), "v": p["E"] @ p["Wv"]}

    def gradients(self, inputs: np.ndarray, first: np.ndarray, targets: np.ndarray, keys: np.ndarray, queries: np.ndarray):
        p, d = self.p, self.width
        logits, (k_in, q_in, k, v, q, shares, mixed) = self.forward(inputs, first, keys, queries, self.tables())
        ok = queries < len(inputs)
        wanted = targets[np.minimum(queries, len(inputs) - 1)]
        logits = logits - logits.max(2, keepdims=True)
        probs = np.exp(logits)
        probs /= probs.sum(2, keepdims=True)
        picked = np.take_along_axis(probs, wanted[:, :, None], 2)[:, :, 0]
        n = ok.sum()
        loss = float(-(np.log(picked + 1e-9) * ok).sum() / n)
        np.put_along_axis(probs, wanted[:, :, None], (picked - 1)[:, :, None], 2)
        out = probs * (ok / n)[:, :, None].astype(np.float32)
        g = {"W": mixed.reshape(-1, 2 * d).T @ out.reshape(-1, out.shape[2]), "b": out.sum((0, 1)), "E": np.zeros_like(p["E"])}
        d_mixed = out @ p["W"].T
        d_heads, d_self = d_mixed[:, :, :d], d_mixed[:, :, d:]
        d_shares = d_heads @ v.transpose(0, 2, 1)
        d_scores = shares * (d_shares - (d_shares * shares).sum(2, keepdims=True))
        g["far"] = np.bincount(np.maximum(self.gap, 0).ravel(), weights=np.where(self.gap < 0, 0, d_scores.sum(0)).ravel(), minlength=len(p["far"])).astype(p["far"].dtype)
        d_k, d_v = d_scores.transpose(0, 2, 1) @ q, shares.transpose(0, 2, 1) @ d_heads
        d_q = d_scores @ k / np.float32(np.sqrt(d))
        for name, at, grad in (("Wk", k_in, d_k), ("Wv", k_in, d_v), ("Wq", q_in, d_q)):
            flat, places = grad.reshape(-1, d), at.ravel()
            g[name] = p["E"][places].T @ flat
            np.add.at(g["E"], places, flat @ p[name].T)
        np.add.at(g["E"], q_in.ravel(), d_self.reshape(-1, d))
        return loss, g


    def gradients_of(self, inputs: np.ndarray, first: np.ndarray, targets: np.ndarray, begin: int, count: int) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """The same as ``gradients`` for ``count`` neighbouring windows from window ``begin`` on, arranged for speed; and the buckets that were met."""
        p, d, context, stride = self.p, self.width, self.context, self.stride
        span, n, scale = context + stride, len(inputs), 1 / np.float32(np.sqrt(d))
        at = np.arange(begin * stride - context, (begin + count) * stride)
        x = inputs[np.clip(at, 0, n - 1)]
        e = p["E"].take(x, axis=0)
        keys, values, queries = e @ p["Wk"], e @ p["Wv"], (e[context:] @ (p["Wq"] * scale)).reshape(count, stride, d)
        step, inner = keys.strides
        view = {"shape": (count, span, d), "strides": (stride * step, step, inner)}
        keys, values = np.lib.stride_tricks.as_strided(keys, **view), np.lib.stride_tricks.as_strided(values, **view)
        scores = queries @ keys.transpose(0, 2, 1)
        scores += np.where(self.gap < 0, -1e9, p["far"][np.maximum(self.gap, 0)]).astype(scores.dtype)
        q_at = np.minimum(at[context:], n - 1)
        begins, lowest = first[q_at].reshape(count, stride), at[0] + np.arange(count) * stride
        for w in np.flatnonzero(begins.max(1) > lowest):
            scores[w][lowest[w] + np.arange(span) < begins[w][:, None]] = -1e9
        shares, total, _ = exponentials(scores)
        shares /= total[:, :, None]
        heads = (shares @ values).reshape(-1, d)
        mixed = np.concatenate([heads, e[context:]], 1)
        logits = mixed @ p["W"]
        logits += p["b"]
        probs, total, _ = exponentials(logits)  # shares of the classes are these over their total
        rows, wanted, ok = np.arange(count * stride), targets[q_at], at[context:] < n
        used = int(ok.sum())
        loss = float(-np.log(probs[rows, wanted][ok] / total[ok] + 1e-9).sum() / used)
        probs[rows, wanted] -= total
        each = (ok / (used * total)).astype(probs.dtype)[:, None]
        g = {"W": (mixed * each).T @ probs, "b": each[:, 0] @ probs}
        d_mixed = probs @ p["W"].T
        d_mixed *= each
        d_heads = d_mixed[:, :d].reshape(count, stride, d)
        d_scores = d_heads @ values.transpose(0, 2, 1)
        d_scores -= np.einsum("ij,ij->i", d_mixed[:, :d], heads).reshape(count, stride, 1)
        d_scores *= shares
        g["far"] = np.bincount(np.maximum(self.gap, 0).ravel(), weights=np.where(self.gap < 0, 0, d_scores.sum(0)).ravel(), minlength=span).astype(p["far"].dtype)
        d_queries = (d_scores @ keys).reshape(-1, d) * scale

        def laid(each: np.ndarray) -> np.ndarray:
            """Windows overlap: what all of them say of a place is added up."""
            out = np.zeros(((count + 1) * stride + span, d), each.dtype)
            for j in range(0, span, stride):
                width = min(stride, span - j)
                out[j : j + count * stride].reshape(count, stride, d)[:, :width] += each[:, j : j + width]
            return out[: len(at)]

        d_keys, d_values = laid(d_scores.transpose(0, 2, 1) @ queries), laid(shares.transpose(0, 2, 1) @ d_heads)
        g["Wk"], g["Wv"], g["Wq"] = e.T @ d_keys, e.T @ d_values, e[context:].T @ d_queries
        each = d_keys @ p["Wk"].T + d_values @ p["Wv"].T
        each[context:] += d_queries @ p["Wq"].T + d_mixed[:, d:]
        order = np.argsort(x, kind="stable")
        found, start = np.unique(x[order], return_index=True)
        g["E"] = np.zeros_like(p["E"])
        g["E"][found] = np.add.reduceat(each.take(order, axis=0), start)
        return loss, g, found


def exponentials(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(scores - c), its sums along the last axis, and c: 0, or the largest score of each row where some row would not fit its type without."""
    ones = np.ones(scores.shape[-1], scores.dtype)
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.exp(scores)
        total = out @ ones
    if total.size and not (1e-30 < total.min() and total.max() < 1e30):
        most = scores.max(-1, keepdims=True)
        np.exp(scores - most, out=out)
        return out, out @ ones, most[..., 0]
    return out, total, 0.0


class Adam:
    """Steps of an ``Attention``."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.steps = p, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))

    def step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        pace = rate * math.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for k, g in grads.items():
            m, s = self.m[k], self.s[k]
            part = g * 0.1
            m *= 0.9
            m += part
            part *= part  # a hundredth of the square
            s *= 0.99
            s += part
            np.sqrt(s, out=part)
            part += 1e-6
            np.divide(m, part, out=part)
            part *= pace
            self.p[k] -= part


class Scorer:
    """Everything needed to score ids: buckets and classes of ids, chances of an id in its class, the network."""

    def __init__(self, counts: np.ndarray, starts_word: np.ndarray, end_id: int, *, classes: int = 64, buckets: int = 4096, **net):
        self.end_id = end_id
        self.classes = np.zeros(len(counts), np.int64)
        half = (classes - 1) // 2
        for k, own in enumerate((np.flatnonzero(starts_word), np.flatnonzero(~starts_word))):
            own = own[own != end_id]
            own = own[np.argsort(-counts[own], kind="stable")]
            mass = np.cumsum(counts[own] + 0.5)
            if len(own):
                self.classes[own] = 1 + k * half + np.minimum((mass - counts[own] / 2) / mass[-1] * half, half - 1).astype(np.int64)
        n = 1 + 2 * half
        total = np.bincount(self.classes, weights=counts + 0.5, minlength=n)
        self.within = np.log10((counts + 0.5) / total[self.classes])
        self.buckets = np.arange(len(counts)) % (buckets // 4)
        top = np.argsort(-counts, kind="stable")[: buckets - buckets // 4]
        self.buckets[top] = buckets // 4 + np.arange(len(top))
        self.net = Attention(buckets, n, **net)
        self.trained = False

    def stream(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids before them, place of the document's first id) of documents one after the other; the end stands before each first id."""
        ids = np.concatenate(docs).astype(np.int64)
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        begin = np.cumsum(lengths) - lengths
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[begin] = self.end_id
        return ids, before, np.repeat(begin, lengths)

    def log10(self, docs: list[np.ndarray], block: int = 256) -> np.ndarray:
        """log10 probability of each document (none may be empty).

        The same as ``forward``, arranged for speed: keys and values are looked up once and windows are views of them;
        what a query must not see for its place alone is in one table, and only windows with a document's beginning need more.
        """
        net, p = self.net, self.net.p
        ids, before, first = self.stream(docs)
        n, stride, context, d = len(ids), net.stride, net.context, net.width
        count = -(-n // stride)
        inputs = np.zeros(context + count * stride, np.int64)
        inputs[context : context + n] = self.buckets[before]
        tables = net.tables()
        found = np.concatenate([tables[k] for k in "kvqe"], 1)
        place = np.where(net.gap < 0, np.float32(-1e9), p["far"][np.maximum(net.gap, 0)]).astype(np.float32)
        begins = np.full(count * stride, n, np.int64)
        begins[:n] = first
        begins = begins.reshape(count, stride)
        lowest = np.arange(count) * stride - context
        cut = begins.max(1) > lowest
        chosen = np.zeros(count * stride, np.int64)
        chosen[:n] = self.classes[ids]
        out = np.empty(count * stride)
        for i in range(0, count, block):
            j = min(i + block, count)
            own = found.take(inputs[i * stride : context + j * stride], axis=0)
            step, inner = own.strides
            view = {"shape": (j - i, context + stride, d), "strides": (stride * step, step, inner)}
            keys, values = (np.lib.stride_tricks.as_strided(own[:, k : k + d], **view) for k in (0, d))
            scores = own[context:, 2 * d : 3 * d].reshape(j - i, stride, d) @ keys.transpose(0, 2, 1)
            scores += place
            for w in np.flatnonzero(cut[i:j]) + i:
                scores[w - i][lowest[w] + np.arange(context + stride) < np.minimum(begins[w], n - 1)[:, None]] = -1e9
            shares, total, _ = exponentials(scores)
            mixed = np.empty(((j - i) * stride, 2 * d), np.float32)
            np.divide(shares @ values, total[:, :, None], out=mixed[:, :d].reshape(j - i, stride, d))
            mixed[:, d:] = own[context:, 3 * d :]
            logits = mixed @ p["W"]
            logits += p["b"]
            _, total, most = exponentials(logits)
            out[i * stride : j * stride] = logits[np.arange(len(logits)), chosen[i * stride : j * stride]] - most - np.log(total)
        each = out[:n] / np.log(10) + self.within[ids]
        return np.add.reduceat(each, np.unique(first))

    def train(self, docs: list[np.ndarray], *, steps: int = 400, batch: int = 64, rate: float = 0.01, seed: int = 1, sample_windows: int = 100_000) -> None:
        docs = [d for d in docs if len(d)]
        if not docs:
            return
        ids, before, first = self.stream(docs)
        chosen, inputs = self.classes[ids], self.buckets[before]
        keys, queries = self.net.windows(len(ids))
        rng, p = np.random.default_rng(seed), self.net.p
        usable = rng.permutation(len(queries))[:sample_windows]
        p["b"][:] = np.log(np.bincount(chosen, minlength=len(p["b"])) + 0.5)
        p["b"] -= p["b"].mean()
        adam = Adam(p)
        for step in range(1, steps + 1):
            drawn = rng.choice(usable, min(batch, len(usable)), replace=False)
            _, grads = self.net.gradients(inputs, first, chosen, keys[drawn], queries[drawn])
            adam.step(grads, rate * min(1.0, 1 + LAST_PACE - step / steps))
        self.trained = True

    def learn(self, docs: list[np.ndarray], adam: Adam, *, rate: float = 0.01 * LAST_PACE, block: int = 256) -> np.ndarray:
        """One step for each block of windows, over all windows of the documents; returns how often each bucket was met."""
        ids, before, first = self.stream(docs)
        chosen, inputs = self.classes[ids], self.buckets[before]
        met, count = np.zeros(len(self.net.p["E"])), -(-len(ids) // self.net.stride)
        for i in range(0, count, block):
            _, grads, found = self.net.gradients_of(inputs, first, chosen, i, min(block, count - i))
            adam.step(grads, rate)
            met[found] += 1
        return met


# Corpus -----------------------------------------------------------------------------------------


def count_words(docs: DataFrame) -> DataFrame:
    """(word, count) of the column ``text``; each task sums up its own words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tally = Vocabulary(300_000), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(known.words, pa.binary()), "count": pa.array(tally, pa.int64())})

        for batch in batches:
            texts = as_bytes(batch.column(0))
            for i in range(0, len(texts), 256):
                ids = known.ids([w for t in texts[i : i + 256] if t for w in t.lower().split()])
                more = np.bincount(ids, minlength=len(known.words))
                more[: len(tally)] += tally
                tally = more
                if len(known.words) > known.most:
                    yield out()
                    known, tally = Vocabulary(known.most), np.zeros(0, np.int64)
        if len(tally):
            yield out()

    return docs.select("text").mapInArrow(tidied(run), "word binary, count bigint").groupBy("word").agg(F.sum("count").alias("count"))


def subword_counts(words: DataFrame, path: str) -> np.ndarray:
    """How often each subword id stands in the counted words: as many numbers as the vocabulary has ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords.load(path)
        total = np.zeros(encoder.size)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            ids, lengths = encoder.encode_flat([b" " + w for w in words])
            total += np.bincount(ids, weights=np.repeat(counts, lengths), minlength=encoder.size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used), "count": pa.array(total[used].astype(np.int64))})

    out = np.zeros(subwords.load(path).size)
    for r in words.mapInArrow(tidied(run), "id bigint, count bigint").groupBy("id").agg(F.sum("count").alias("count")).collect():
        out[r["id"]] = r["count"]
    return out


def least_head_count(words: DataFrame, head_words: int) -> int:
    """The least count such that no more than ``head_words`` words have it or more."""
    by_size = words.select(F.floor(F.log2("count") * 4).cast("int").alias("size")).groupBy("size").count().collect()
    total = 0
    for r in sorted(by_size, key=lambda r: -r["size"]):  # a few hundred sizes at most
        total += r["count"]
        if total > head_words:
            return int(2 ** ((r["size"] + 1) / 4)) + 1
    return 1


def sample_ids(docs: DataFrame, n: int, sample_docs: int, path: str, end_id: int, longest: int = 4096) -> list[np.ndarray]:
    """Ids of about ``sample_docs`` of the ``n`` training documents; of a longer one, ``longest`` ids from a place given by its hash."""
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, sample_docs / max(n, 1)) * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords.load(path)
        for batch in batches:
            out = []
            for t in as_bytes(batch.column(0)):
                ids = np.append(encoder.encode_flat([b" " + w for w in (t or b"").lower().split()])[0], np.uint32(end_id))
                at = int(ids.sum()) % (len(ids) - longest) if len(ids) > longest else 0
                out.append(ids[at : at + longest].astype("<u4").tobytes())
            yield pa.RecordBatch.from_pydict({"ids": pa.array(out, pa.binary())})

    rows = docs.where(share).select("text").mapInArrow(tidied(run), "ids binary").orderBy(F.xxhash64("ids")).limit(2 * sample_docs).collect()
    return [np.frombuffer(r["ids"], "<u4") for r in rows]


def id_rows(training: DataFrame, path: str, end_id: int) -> DataFrame:
    """(ids) of the column ``text``: the subword ids of its words and the end, as ``as_ids`` packs them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = subwords.Chunks(_SpacedEncoder(subwords.load(path)))
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for begin, end in groups(texts):
                chunks.trim()
                numbers = [chunks.known.ids((t or b"").lower().split()) for t in texts[begin:end]]
                chunks.learn()
                yield pa.RecordBatch.from_pydict({"ids": pa.array([packed(np.append(chunks.gather(n), np.uint32(end_id))) for n in numbers], pa.binary())})

    return training.select("text").mapInArrow(tidied(run), "ids binary")


def packed(ids: np.ndarray) -> bytes:
    """Ids in two bytes each where all of them fit, else in four; the first byte says which."""
    return b"2" + ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else b"4" + ids.astype("<u4").tobytes()


def unpacked(row: bytes) -> np.ndarray:
    return np.frombuffer(row, "<u2" if row[:1] == b"2" else "<u4", offset=1)


def trained_on_all(training: DataFrame, scorer: Scorer, path: str) -> Scorer:
    """``scorer`` after every task has gone once through all its own texts from there."""
    return trained_on_ids(id_rows(training, path, scorer.end_id), scorer)


def trained_on_ids(training: DataFrame, scorer: Scorer) -> Scorer:
    """The same for rows of ``packed`` ids in the column ``ids``."""
    shared = training.sparkSession.sparkContext.broadcast(scorer)
    names, width = [k for k in scorer.net.p if k != "E"], scorer.net.width
    layers = -(-sum(scorer.net.p[k].size for k in names) // width)

    def matrix(p: dict[str, np.ndarray]) -> np.ndarray:
        flat = np.concatenate([p[k].ravel() for k in names])
        return np.concatenate([p["E"], np.concatenate([flat, np.zeros(layers * width - len(flat))]).reshape(layers, width)]).astype(np.float64)

    def work(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        own = copy.deepcopy(shared.value)
        adam, seen = Adam(own.net.p), set()
        met = np.zeros(len(own.net.p["E"]))
        for batch in batches:
            rows = batch.column(0).to_pylist()
            rows = [r for r, k in zip(rows, text_keys(rows).tolist(), strict=True) if not (k in seen or seen.add(k))]
            for begin, end in groups(rows, 1 << 19):
                met += own.learn([unpacked(r) for r in rows[begin:end]], adam)
        return matrix(own.net.p), np.concatenate([met, np.full(layers, adam.steps)])

    found = mixed(training.select("ids"), matrix(scorer.net.p), work).astype(np.float32)
    out, at = copy.deepcopy(scorer), 0
    out.net.p["E"], flat = found[:-layers], found[-layers:].ravel()
    for k in names:
        out.net.p[k] = flat[at : at + out.net.p[k].size].reshape(out.net.p[k].shape)
        at += out.net.p[k].size
    return out


def score(docs: DataFrame, held_out, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, head_words: int = 200_000, sample_docs: int = 1_500, classes: int = 64, steps: int = 400) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a column of ``docs``: rows where it is true are not learned from.
    """
    spark = docs.sparkSession
    path = tokenizer or subwords.default_path()
    chosen = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    training = chosen.where(~F.col("held_out"))
    words = stored(count_words(training), "words")
    n_docs = training.count()
    in_words, distinct = words.agg(F.sum("count"), F.count("*")).first()
    train_tokens, vocabulary = (in_words or 0) + n_docs, distinct + (n_docs > 0)
    below = np.log10(train_tokens + 0.5 * (vocabulary + 1))

    encoder = subwords.load(path)
    end_id = encoder.whole.token_to_id(encoder.special[0].decode()) if encoder.special else encoder.size - 1
    counts = subword_counts(words, path)
    counts[end_id] += n_docs
    starts_word = np.array([(encoder.whole.id_to_token(i) or "")[:1] == "Ġ" for i in range(encoder.size)])
    scorer = Scorer(counts, starts_word, end_id, classes=classes)
    scorer.train(sample_ids(training, n_docs, sample_docs, path, end_id), steps=steps)

    least = least_head_count(words, head_words)
    head = words.where(F.col("count") >= least).toArrow()
    shared = spark.sparkContext.broadcast((dict(zip(head.column("word").to_pylist(), head.column("count").to_pylist(), strict=True)), n_docs))
    pair = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    kinds = [("row", T.LongType()), ("n_tokens", T.LongType()), ("n_head", T.LongType()), ("base_head", T.DoubleType()), ("rest", T.ArrayType(pair)), ("ids", T.BinaryType())]
    schema = T.StructType([chosen.schema["doc_id"], chosen.schema["held_out"], *(T.StructField(c, k) for c, k in kinds)])
    arrow_pair = pa.struct([("word", pa.binary()), ("n", pa.int64())])
    arrow_kinds = {"base_head": pa.float64(), "ids": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, ends = shared.value
        chunks = subwords.Chunks(_SpacedEncoder(subwords.load(path)))
        row = TaskContext.get().partitionId() << 40

        def of_words(new: list[bytes]) -> np.ndarray:
            """[word, (log10 of the numerator, 1 if it is in the head)]; words outside the head are left for the join."""
            own = np.array([head.get(w, -1) for w in new], float)
            return np.stack([np.where(own < 0, 0, np.log10(np.maximum(own, 0) + 0.5)), own >= 0], 1)

        end_part = np.log10(ends + 0.5)
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for begin, end in groups(texts):
                made = {c: [] for c, _ in kinds}
                rest_words, rest_counts, rest_ends = [], [], [0]
                chunks.trim()
                numbers = [chunks.known.ids(t.lower().split()) for t in texts[begin:end]]
                chunks.learn()
                table = chunks.known.scored(of_words) if chunks.known.words else np.zeros((0, 2))
                for own in numbers:
                    values = table[own]
                    sums = values.sum(0)
                    made["row"].append(row)
                    row += 1
                    made["n_tokens"].append(len(own) + 1)
                    made["n_head"].append(int(sums[1]) + (ends > 0))
                    made["base_head"].append(float(sums[0] + end_part - (sums[1] + 1) * below))
                    made["ids"].append(packed(np.append(chunks.gather(own), np.uint32(end_id))))
                    outside, times = np.unique(own[values[:, 1] == 0], return_counts=True)
                    rest_words += [chunks.known.words[k] for k in outside.tolist()]
                    rest_counts += times.tolist()
                    rest_ends.append(len(rest_words))
                rest = pa.StructArray.from_arrays([pa.array(rest_words, pa.binary()), pa.array(rest_counts, pa.int64())], fields=list(arrow_pair))
                made["rest"] = pa.ListArray.from_arrays(pa.array(rest_ends, pa.int32()), rest)
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, arrow_kinds.get(c, pa.int64())) for c, v in made.items()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin), *arrays], names=schema.names)

    known = stored(chosen.mapInArrow(tidied(run), schema), "ids")
    scored = scores_of_ids(known.drop("rest"), trained_on_ids(known.where(~F.col("held_out")), scorer))
    rest = known.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n")
    counted = rest.join(words.where(F.col("count") < least), "word", "left")
    part = F.col("n") * (F.log10(F.coalesce("count", F.lit(0)) + 0.5) - F.lit(float(below)))
    sums = counted.groupBy("row").agg(F.sum(part).alias("base_rest"), F.sum(F.when(F.col("count") > 0, F.col("n"))).alias("n_rest"))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_head") + F.coalesce("base_rest", F.lit(0.0))).alias("base_score"),
        "score",
    )


def scores_of_ids(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """``rows`` with ``score`` in place of their ``packed`` ids (the last column), stored."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            scores = [x for i in range(0, len(ids), 128) for x in shared.value.log10([unpacked(r) for r in ids.slice(i, 128).to_pylist()]).tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=schema.names)

    return stored(rows.mapInArrow(tidied(run), schema), "scores")


class _SpacedEncoder:
    """Encodes words as they stand after a space."""

    def __init__(self, encoder: subwords.Encoder):
        self.encoder = encoder

    def encode_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.encode_flat([b" " + w for w in words])
