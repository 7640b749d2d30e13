"""Subword ids, packing and language-model scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import language_id, lm_score, packing, subwords

ODD = [
    "a\tb  c\n\n d   \n",
    "  leading",
    "\n\nx y\n",
    "a b c  d e",
    "x\x1c\x1d y",
    "it's we'll 'tis I'M 12 345a ?!.. <|endoftext|> z",
    "naïve — “quotes” …  ok",
    "日本語 テスト。 emoji 👩‍👩‍👧 done",
    "\t\t x\t\n y",
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(subwords.default_path())


def plain_ids(whole, text):
    return whole.encode(text, add_special_tokens=False).ids


def test_chunks_give_the_same_ids(whole, docs):
    chunks = subwords.Chunks(subwords.load(subwords.default_path()), most=50)
    texts = [r["text"] or "" for r in docs.collect()] + ODD * 2
    for part in (texts, texts[::-1], *([t] for t in texts)):
        ids, _ = chunks.encode_all([t.encode() for t in part])
        assert [x.tolist() for x in ids] == [plain_ids(whole, t) for t in part]


def check_packing(whole, frame, pieces, window=2048):
    rows = [r.asDict() for r in pieces.collect()]
    want = Counter((r["doc_id"], tuple([*plain_ids(whole, r["text"] or ""), 1])) for r in frame.collect())
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    got = Counter()
    whole_rows = {}
    for r in rows:
        whole_rows.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for (doc, n), own in whole_rows.items():  # rows with one id and length are interchangeable here
        starts = sorted((r["start"], tuple(r["ids"])) for r in own)
        copies = sum(s == 0 for s, _ in starts)
        assert sum(len(i) for _, i in starts) == n * copies
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        if copies == 1:
            got[doc, tuple(x for _, i in starts for x in i)] += 1
        else:
            for key in [k for k in want if k[0] == doc and len(k[1]) == n]:
                got[key] = want[key]
    assert got == want
    return by_sequence


def test_packing_round_trip(whole, spark, docs, no_docs, null_docs):
    frame = docs.select("doc_id", "text", "score").union(spark.createDataFrame([(100 + i, t, 0.0) for i, t in enumerate(ODD)], "doc_id long, text string, score double"))
    for shard in (1 << 24, 3000):
        found = check_packing(whole, frame, packing.pack(frame, shard_bytes=shard, window=256, with_ids=True), 256)
        short = [s for s in found.values() if sum(r["length"] for r in s) < 256]
        assert len(short) <= 2
    assert packing.pack(no_docs).count() == 0
    assert [r["length"] for r in packing.pack(null_docs).collect()] == [1, 1, 1]


def test_neighbours_equal_plain_bm25():
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.5, rng.integers(3, 60)) % 80 for _ in range(40)]
    index = packing.Index(docs, query_terms=6)
    df = Counter(t for d in docs for t in set(d.tolist()))
    mean = np.mean([len(d) for d in docs])

    def idf(t):
        return math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5))

    used = np.zeros(40, bool)
    used[[3, 5]] = True
    for q in (0, 7, 20):
        got = [int(d) for d in index.neighbours(q, used)]
        own = index.by_doc[index.doc_starts[q] : index.doc_starts[q + 1]]
        terms = np.unique(np.concatenate(docs))
        query = sorted((t for t in set(docs[q].tolist()) if df[t] > 1), key=idf, reverse=True)
        least = idf(query[:6][-1])
        assert len(own) == len(set(docs[q].tolist()))
        chosen = [terms[t] for t in own if index.counts[t] > 1]
        chosen = [t for t in chosen if idf(t) > least] if len(chosen) > 6 else chosen
        scores = {d: sum(idf(t) * Counter(docs[d].tolist())[t] * 2.2 / (Counter(docs[d].tolist())[t] + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean)) for t in chosen if t in docs[d]) for d in range(40) if not used[d]}
        sure = {d for d, s in scores.items() if s > 0}
        assert sure <= set(got) and not set(got) & {3, 5}
        if len(own[index.counts[own] > 1]) <= 6:
            assert got == sorted(sure, key=lambda d: -scores[d])


def test_copies_are_packed_together(whole, spark):
    rng = np.random.default_rng(4)
    topics = [[f"t{k}x{i}" for i in range(40)] for k in range(5)]
    rows = [(i, " ".join(rng.choice(topics[i % 5], 30))) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = check_packing(whole, frame, packing.pack(frame, window=512, with_ids=True), 512)
    mixed = [len({r["doc_id"] % 5 for r in s}) for s in found.values()]
    assert np.mean(mixed) < 2.2


# Scores -----------------------------------------------------------------------------------------


def test_attention_gradients():
    net = lm_score.Attention(20, 7, width=4, context=3, stride=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(2)
    inputs, targets = rng.integers(0, 20, 22), rng.integers(0, 7, 22)
    first = np.repeat([0, 9, 10], [9, 1, 12])
    keys, queries = net.windows(22)
    _, grads = net.gradients(inputs, first, targets, keys, queries)
    for name, g in grads.items():
        for _ in range(5):
            at = tuple(rng.integers(s) for s in g.shape)
            keep, eps = net.p[name][at], 1e-5
            losses = []
            for change in (eps, -eps):
                net.p[name][at] = keep + change
                losses.append(net.gradients(inputs, first, targets, keys, queries)[0])
            net.p[name][at] = keep
            assert g[at] == pytest.approx((losses[0] - losses[1]) / (2 * eps), abs=1e-6)


def plain_score(scorer, ids):
    """One id after the other, each with every id its window lets it see."""
    net, p, total = scorer.net, scorer.net.p, 0.0
    before = [scorer.end_id, *ids[:-1].tolist()]
    for i, target in enumerate(ids.tolist()):
        begin = i - i % net.stride - net.context
        seen = [scorer.buckets[x] for x in before[max(0, begin) : i + 1]]
        gaps = np.arange(len(seen))[::-1]
        e = p["E"][seen]
        scores = (e[-1] @ p["Wq"]) @ (e @ p["Wk"]).T / math.sqrt(net.width) + p["far"][gaps]
        shares = np.exp(scores - scores.max())
        shares /= shares.sum()
        logits = np.concatenate([shares @ (e @ p["Wv"]), e[-1]]) @ p["W"] + p["b"]
        c = scorer.classes[target]
        total += (logits[c] - np.log(np.exp(logits).sum())) / math.log(10) + scorer.within[target]
    return total


def test_windows_score_each_id_once():
    rng = np.random.default_rng(7)
    counts = rng.integers(0, 50, 200).astype(float)
    scorer = lm_score.Scorer(counts, np.arange(200) % 2 == 0, 199, classes=9, buckets=64, width=8, context=5, stride=3)
    one = rng.integers(0, 199, 30).astype(np.uint32)
    scorer.train([one, rng.integers(0, 199, 50).astype(np.uint32)], steps=5)
    # alone, a document's windows begin at its first id, as in the plain rule
    assert scorer.log10([one])[0] == pytest.approx(plain_score(scorer, one), rel=1e-4)
    together = [one, *(rng.integers(0, 199, k).astype(np.uint32) for k in (1, 2, 40))]
    ids, before, first = scorer.stream(together)
    keys, queries = scorer.net.windows(len(ids))
    logits, _ = scorer.net.forward(scorer.buckets[before], first, keys, queries, scorer.net.tables())
    logits = logits.reshape(-1, logits.shape[2])[: len(ids)]
    each = logits[np.arange(len(ids)), scorer.classes[ids]] - np.log(np.exp(logits).sum(1))
    assert scorer.log10(together) == pytest.approx(np.add.reduceat(each / math.log(10) + scorer.within[ids], np.unique(first)), rel=1e-4)
    total = np.zeros(len(scorer.net.p["b"]))
    for c in range(len(total)):
        total[c] = (10 ** scorer.within[scorer.classes == c]).sum()
    assert total[np.bincount(scorer.classes, minlength=len(total)) > 0] == pytest.approx(1)
    # no document sees another
    other = rng.integers(0, 199, 17).astype(np.uint32)
    a, b = scorer.log10([one, other]), scorer.log10([one, rng.integers(0, 199, 17).astype(np.uint32)])
    assert a[0] == pytest.approx(b[0])


def test_training_learns_what_attention_must():
    """The class after an even id tells which of two openings the document had."""
    rng = np.random.default_rng(1)
    docs = [np.array([s, *([2] * 8), s + 10], np.uint32) for s in rng.integers(0, 2, 600)]
    scorer = lm_score.Scorer(np.bincount(np.concatenate(docs), minlength=16).astype(float), np.zeros(16, bool), 15, classes=15, buckets=64, width=8, context=16, stride=4)
    before = scorer.log10(docs[:50]).mean()
    scorer.train(docs, steps=300)
    assert scorer.log10(docs[:50]).mean() > before + 2


def test_base_scores(spark, docs, no_docs, null_docs):
    held = language_id.held_out("doc_id", 5, 1)
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    training = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for t in training for w in t.lower().split())
    counts["end"] = len(training)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        tokens = [*t.lower().split(), "end"]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens)
        want[i, zlib.crc32(str(i).encode()) % 5 == 1, len(tokens), sum(counts[x] > 0 for x in tokens), n, round(base, 6)] += 1
    for head in (200_000, 3):
        got = lm_score.score(docs, held, steps=20, head_words=head).collect()
        assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lm_score.score(no_docs, held, steps=5).count() == 0
    assert lm_score.score(null_docs, F.lit(True), steps=5).count() == null_docs.count()


@pytest.mark.parametrize(("context", "stride"), [(3, 4), (4, 4), (7, 3)])
def test_gradients_of_neighbouring_windows(context, stride):
    net = lm_score.Attention(20, 7, width=4, context=context, stride=stride)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(2)
    inputs, targets = rng.integers(0, 20, 22), rng.integers(0, 7, 22)
    first = np.repeat([0, 9, 10], [9, 1, 12])
    keys, queries = net.windows(22)
    for begin, end in ((0, len(keys)), (1, 3), (2, len(keys))):
        loss, want = net.gradients(inputs, first, targets, keys[begin:end], queries[begin:end])
        again, got, found = net.gradients_of(inputs, first, targets, begin, end - begin)
        assert again == pytest.approx(loss) and set(np.flatnonzero(want["E"].any(1))) <= set(found)
        for name, g in want.items():
            assert got[name] == pytest.approx(g, abs=1e-7)


def test_every_training_document_teaches(spark):
    """The start sees documents of one kind alone; what follows what in the others is learned from all of them."""
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("sun", "tree", "river", "stone") for b in ("s", "ing", "light", "side")]
    texts = [" ".join(x for k in rng.integers(0, 16, 60) for x in (words[k], words[(k + 5) % 16], words[(k + 10) % 16])) for _ in range(240)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    path = subwords.default_path()
    counts = lm_score.subword_counts(lm_score.count_words(frame), path)
    encoder = subwords.load(path)
    counts[0] += len(texts)
    scorer = lm_score.Scorer(counts, np.array([(encoder.whole.id_to_token(i) or "")[:1] == "Ġ" for i in range(encoder.size)]), 0)

    def ids(ts):
        return [np.append(encoder.encode_flat([b" " + w for w in t.encode().split()])[0], np.uint32(0)) for t in ts]

    scorer.train(ids(["sunside"] * 3), steps=5)
    before = scorer.log10(ids(texts[:20])).mean()
    after = lm_score.trained_on_all(frame, scorer, path)
    assert after.log10(ids(texts[:20])).mean() > before + 5
    assert scorer.log10(ids(texts[:20])).mean() == pytest.approx(before)


def test_texts_are_cut_into_ids_once(spark, tmp_path):
    """Passes over the texts: counts of words, number of documents, the start of the network, ids."""
    noted = str(tmp_path / "passes")

    def note(batches):
        with open(noted, "a") as f:
            f.write("x")
        yield from batches

    texts = [(k, f"river stone {k} light{k % 7}" if k else None) for k in range(40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).mapInArrow(note, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.score(frame, F.col("doc_id") % 5 == 1, steps=5).collect()}
    assert len(got) == 40 and got[0]["n_tokens"] == 1 and got[3]["n_tokens"] == 5
    with open(noted) as f:
        assert len(f.read()) <= 4


def test_stored_ids_teach_and_score_as_texts_do(spark):
    path = subwords.default_path()
    encoder = subwords.load(path)
    frame = spark.createDataFrame([(f"sun river {k % 9} stone{k}",) for k in range(60)] + [(None,), ("",)], "text string").coalesce(1)
    scorer = lm_score.Scorer(np.ones(encoder.size), np.arange(encoder.size) % 2 == 0, 1, classes=9, buckets=64)
    rows = lm_score.id_rows(frame, path, 1)
    ids = [lm_score.unpacked(r["ids"]) for r in rows.collect()]
    assert [len(x) for x in ids[-2:]] == [1, 1] and all(x[-1] == 1 for x in ids)
    taught = lm_score.trained_on_ids(rows, scorer)
    for name, v in lm_score.trained_on_all(frame, scorer, path).net.p.items():
        assert taught.net.p[name] == pytest.approx(v)
    got = [r["score"] for r in lm_score.scores_of_ids(rows, taught).collect()]
    assert got == pytest.approx(taught.log10(ids).tolist(), rel=1e-5)
    for size in (10, 65_535, 65_536, 100_000):
        assert lm_score.unpacked(lm_score.packed(np.array([0, size], np.uint32))).tolist() == [0, size]


def test_exponentials_of_any_size():
    """Sums do not overflow or vanish where scores are far from zero."""
    scores = np.array([[1.0, 2.0, -1e9], [300.0, 299.0, 0.0], [-300.0, -301.0, -1e9]], np.float32)
    for rows in (scores, scores[:1], scores[2:]):
        out, total, most = lm_score.exponentials(rows)
        want = np.exp(rows.astype(float) - rows.max(1, keepdims=True))
        assert out / total[:, None] == pytest.approx(want / want.sum(1, keepdims=True), rel=1e-5)
        assert most + np.log(total) == pytest.approx(rows.max(1) + np.log(want.sum(1)), rel=1e-5)
