"""Language identification with a bidirectional gated recurrent network over bytes.

A text is read word by word, with a space on either side; a longer word is read in pieces of ``longest`` bytes. Over
each piece one recurrent layer runs forward and one backward, and every position gets a probability of each language from
both states. A document's probabilities are the mean over all positions of its whole text; a word is worked out once
in a task and counted as often as it stands in the text.

Training is numpy: cross entropy at every position, back-propagation through time, Adam. It sees a
bounded, documented sample of the labelled rows: about ``sample_docs`` documents, as many of each language, chosen by a
hash of their id, and of their words ``sample_words`` (word, language) pairs, chosen by a hash. Words are drawn as often as they
stand in the sample, languages equally often. Prediction sees nothing but the text.

A null text, or one without a letter, is ``und`` with score 0. So is every text if there is no labelled row to learn
from. A text in the one learned language scores 1. Repeated rows get equal answers; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import Vocabulary, as_bytes, tidied, with_columns

UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def pieces(word: bytes, longest: int) -> list[bytes]:
    whole = b" " + word + b" "
    return [whole[i : i + longest] for i in range(0, len(whole), longest)]


def padded(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """[sequence, position] of bytes and the lengths."""
    lengths = np.fromiter(map(len, seqs), np.int64, len(seqs))
    out = np.zeros((len(seqs), int(lengths.max(initial=1))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(seqs), np.uint8)
    return out, lengths


class Gru:
    """Two gated recurrent layers, one for each direction, and a softmax over their states."""

    def __init__(self, classes: int, hidden: int = 16, embed: int = 12, seed: int = 1):
        rng = np.random.default_rng(seed)

        def weights(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.hidden = hidden
        self.p = {"E": weights(256, embed) * 4, "O": weights(2 * hidden, classes), "o": np.zeros(classes, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": weights(embed, 3 * hidden), f"U{d}": weights(hidden, 3 * hidden), f"b{d}": np.zeros(3 * hidden, np.float32)}

    def _run(self, d: str, bytes_: np.ndarray, mask: np.ndarray, keep: bool):
        """States [position, sequence, hidden] of one direction; a padded position keeps the state before it."""
        p, h = self.p, self.hidden
        inputs = p["E"] @ p[f"W{d}"] + p[f"b{d}"]
        state = np.zeros((len(bytes_), h), np.float32)
        steps = range(bytes_.shape[1]) if d == "f" else range(bytes_.shape[1] - 1, -1, -1)
        states = np.zeros((bytes_.shape[1], len(bytes_), h), np.float32)
        tape = []
        recur = p[f"U{d}"]
        for t in steps:
            x = inputs[bytes_[:, t]]
            gates = _sigmoid(x[:, : 2 * h] + state @ recur[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            rs = r * state
            new = np.tanh(x[:, 2 * h :] + rs @ recur[:, 2 * h :])
            m = mask[:, t : t + 1]
            after = state + m * z * (new - state)
            if keep:
                tape.append((t, state, z, r, rs, new, m))
            states[t] = state = after
        return states, tape

    def log_probs(self, bytes_: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(d, bytes_, mask, False)[0] for d in "fb"], 2)
        logits = both @ self.p["O"] + self.p["o"]
        logits -= logits.max(2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(2, keepdims=True))

    def gradients(self, bytes_: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions and its gradients, by back-propagation through time in both directions."""
        p, h = self.p, self.hidden
        mask = (np.arange(bytes_.shape[1]) < lengths[:, None]).astype(np.float32)
        runs = {d: self._run(d, bytes_, mask, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], 2)
        logits = both @ p["O"] + p["o"]
        logits -= logits.max(2, keepdims=True)
        probs = np.exp(logits)
        probs /= probs.sum(2, keepdims=True)
        n, weight = mask.sum(), mask.T[:, :, None]
        picked = probs[:, np.arange(len(labels)), labels]
        loss = float(-(np.log(picked + 1e-9) * mask.T).sum() / n)
        d_logits = probs
        d_logits[:, np.arange(len(labels)), labels] -= 1
        d_logits = (d_logits * weight / n).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        flat = d_logits.reshape(-1, d_logits.shape[2])
        g["O"], g["o"] = both.reshape(-1, 2 * h).T @ flat, flat.sum(0)
        d_both = d_logits @ p["O"].T
        for k, d in enumerate("fb"):
            d_out, recur = d_both[:, :, k * h : (k + 1) * h], p[f"U{d}"]
            d_inputs = np.zeros((256, 3 * h), np.float32)
            carry = np.zeros((len(bytes_), h), np.float32)
            for t, state, z, r, rs, new, m in reversed(runs[d][1]):
                total = carry + d_out[t]
                moved = total * m
                d_new = moved * z * (1 - new * new)
                d_rs = d_new @ recur[:, 2 * h :].T
                d_gates = np.concatenate([moved * (new - state) * z * (1 - z), d_rs * state * r * (1 - r)], 1)
                g[f"U{d}"][:, 2 * h :] += rs.T @ d_new
                g[f"U{d}"][:, : 2 * h] += state.T @ d_gates
                carry = total - moved * z + d_rs * r + d_gates @ recur[:, : 2 * h].T
                np.add.at(d_inputs, bytes_[:, t], np.concatenate([d_gates, d_new], 1))
            g[f"b{d}"] = d_inputs.sum(0)
            g[f"W{d}"] = p["E"].T @ d_inputs
            g["E"] += d_inputs @ p[f"W{d}"].T
        return loss, g


class Identifier:
    """Learned languages and the network that tells them apart."""

    def __init__(self, languages: list[str], net: Gru | None, longest: int):
        self.languages, self.net, self.longest = languages, net, longest

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """[word, (sums of the positions' probabilities, positions)]."""
        k = len(self.languages)
        out = np.zeros((len(words), k + 1))
        seqs, owner = [], []
        for i, w in enumerate(words):
            for piece in pieces(w, self.longest):
                seqs.append(piece)
                owner.append(i)
        owner = np.array(owner, np.int64)
        lengths = np.fromiter(map(len, seqs), np.int64, len(seqs))
        by_length = np.argsort(lengths, kind="stable")
        for i in range(0, len(by_length), 2048):
            chosen = by_length[i : i + 2048]
            bytes_, n = padded([seqs[j] for j in chosen])
            mask = (np.arange(bytes_.shape[1]) < n[:, None]).astype(np.float32)
            if self.net is None:
                sums = n[:, None].astype(float)
            else:
                sums = (np.exp(self.net.log_probs(bytes_, mask)) * mask.T[:, :, None]).sum(0)
            np.add.at(out, owner[chosen], np.concatenate([sums, n[:, None]], 1))
        return out


def train(rows: list[tuple[str, bytes, int]], *, longest: int = 24, steps: int = 400, batch: int = 256, rate: float = 0.01, seed: int = 1) -> Identifier:
    """``rows``: (language, word, times)."""
    rows = sorted(rows)
    languages = sorted({r[0] for r in rows})
    if len(languages) < 2:
        return Identifier(languages, None, longest)
    rng = np.random.default_rng(seed)
    net = Gru(len(languages), seed=seed)
    place = {name: k for k, name in enumerate(languages)}
    labels = np.array([place[r[0]] for r in rows])
    times = np.array([r[2] for r in rows], float)
    chance = times / np.bincount(labels, weights=times)[labels]
    chance = np.cumsum(chance / chance.sum())
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        drawn = np.minimum(np.searchsorted(chance, rng.random(batch)), len(rows) - 1)
        cut = [pieces(rows[i][1], longest) for i in drawn]
        seqs = [c[rng.integers(len(c))] for c in cut]
        bytes_, lengths = padded(seqs)
        _, grads = net.gradients(bytes_, lengths, labels[drawn])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        pace = rate * min(1.0, 1.2 - step / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.p[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return Identifier(languages, net, longest)


def sampled_words(docs: DataFrame, *, sample_docs: int, sample_words: int) -> list[tuple[str, bytes, int]]:
    """(language, word, times) of the training sample of ``docs`` (doc_id, text, label)."""
    totals = {r["label"]: r["count"] for r in docs.groupBy("label").count().collect()}
    if not totals:
        return []
    each = sample_docs / len(totals)
    share = F.create_map(*[F.lit(x) for name, n in sorted(totals.items()) for x in (name, min(1.0, each / n))])
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("label")] * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: dict[tuple[str, bytes], int] = {}
            for label, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                for w in text.split() if text else ():
                    tally[label, w] = tally.get((label, w), 0) + 1
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array([k[0] for k in tally], pa.string()), "word": pa.array([k[1] for k in tally], pa.binary()), "n": pa.array(tally.values(), pa.int64())}
            )

    counted = drawn.select("label", "text").mapInArrow(tidied(run), "label string, word binary, n bigint").groupBy("label", "word").agg(F.sum("n").alias("n"))
    table = counted.orderBy(F.xxhash64("word"), "label").limit(sample_words)
    return [(r["label"], bytes(r["word"]), r["n"]) for r in table.collect()]


def learn(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample_docs: int = 2_000, sample_words: int = 100_000, **how) -> Identifier:
    """The identifier learned from ``labelled``; rows without a label or a text are left out."""
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
    rows = rows.where("text IS NOT NULL AND label IS NOT NULL")
    return train(sampled_words(rows, sample_docs=sample_docs, sample_words=sample_words), **how)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode(errors="ignore")))


def identify(docs: DataFrame, identifier: Identifier, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` appended."""
    shared = docs.sparkSession.sparkContext.broadcast(identifier)
    fields = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def start():
        model, known = shared.value, Vocabulary()

        def work(texts: pa.Array):
            known.trim()
            plain = [t if t and model.languages and has_letter(t) else None for t in as_bytes(texts)]
            ids = [None if t is None else known.ids(t.split()) for t in plain]
            names, scores = [], []
            table = known.scored(model.of_words)
            for own in ids:
                if own is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                sums = table[own].sum(0)
                best = int(sums[:-1].argmax())
                names.append(model.languages[best])
                scores.append(min(1.0, round(float(sums[best] / sums[-1]), 6)))
            return names, scores

        return work

    return with_columns(docs, [text_col], start, fields)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``part``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part
