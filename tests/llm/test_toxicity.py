"""The toxicity network: gradients, whole texts, calibration and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm import toxicity


def net_and_texts(seed=3, bits=6):
    rng = np.random.default_rng(seed)
    net = toxicity.Network(bits=bits, embed=3, filters=2, seed=seed)
    net.e = rng.normal(size=net.e.shape)
    net.p = {k: rng.normal(size=v.shape) for k, v in net.p.items()}
    return net, [rng.integers(0, 1 << bits, (n, toxicity.FEATURES)) for n in (5, 0, 1, 9)]


def test_gradients_match_differences():
    net, texts = net_and_texts()
    labels = np.array([1, 0, 1, 0])
    _, grads, found, d_buckets = net.gradients(texts, labels)
    rng = np.random.default_rng(0)

    def slope(values, at, eps=1e-6):
        keep = values[at]
        values[at] = keep + eps
        up = net.gradients(texts, labels)[0]
        values[at] = keep - eps
        down = net.gradients(texts, labels)[0]
        values[at] = keep
        return (up - down) / (2 * eps)

    for name, g in grads.items():
        for _ in range(4):
            at = tuple(rng.integers(s) for s in g.shape)
            assert g[at] == pytest.approx(slope(net.p[name], at), abs=1e-5)
    dense = np.zeros_like(net.e)
    dense[found] = d_buckets
    for row in [*found[:10], *range(5)]:
        assert dense[row, 1] == pytest.approx(slope(net.e, (row, 1)), abs=1e-5)


@pytest.mark.parametrize(("piece", "most"), [(16_384, 32_768), (1, 1), (3, 7), (4, 1000)])
def test_pieces_of_a_text_do_not_matter(piece, most):
    net, texts = net_and_texts()
    languages = toxicity.Languages(["a", "b"], np.random.default_rng(1).normal(size=(64, 2)))
    scorer = toxicity.Scorer(0.0, net, languages, np.array([0.5, -0.5, 0.1]))
    buckets = np.concatenate(texts)
    table = np.concatenate([net.parts(net.vectors(buckets)), languages.of_buckets(buckets)], 1)
    table = np.concatenate([table, np.zeros((1, table.shape[1]))])
    ends = np.cumsum([len(t) for t in texts])
    ids = [np.arange(e - len(t), e) for t, e in zip(texts, ends, strict=True)]
    logits, cuts = scorer.read(table, ids, len(table) - 1, piece=piece, most=most)
    for t, logit, cut in zip(texts, logits, cuts, strict=True):
        x = np.concatenate([net.vectors(t) if len(t) else np.zeros((1, 3)), np.zeros((2, 3))])
        n = max(1, len(t))
        largest = [max(x[i : i + w].ravel() @ net.p[f"W{w}"][:, f] + net.p[f"b{w}"][f] for i in range(n)) for w in net.widths for f in range(2)]
        assert logit == pytest.approx(float(np.maximum(largest, 0) @ net.p["v"] + net.p["c"][0]), rel=1e-5, abs=1e-5)
        assert cut == scorer.cuts[-1 if not len(t) else languages.of_buckets(t).sum(0).argmax()]


def test_cut_lies_in_the_gap():
    assert toxicity.best_cut(np.array([0.0, 1.0, 5.0, 7.0]), np.array([0, 0, 1, 1])) == 3.0
    assert toxicity.best_cut(np.array([2.0, 2.0, 2.0]), np.array([0, 1, 1])) in (1.0, 3.0)
    assert -1 < toxicity.best_cut(np.array([-3.0, -1.0, 0.0, 1.0, 3.0, 9.0]), np.array([0, 0, 1, 0, 1, 1])) < 3


def test_words_and_forms_of_a_stem():
    texts = pa.array(["Stem-one, ÉTÉ 3x", None, "", "…"])
    assert list(toxicity.words_of(texts)) == [[b"stem", b"one", "été".encode(), b"3x"], [], [], ["…".encode()]]
    a, b, c = toxicity.buckets_of([b"stemming", b"stemmed", b"ing"], 18)
    assert a[0] != b[0] and a[1:3].tolist() == b[1:3].tolist() and set(c) == {c[0]}


def corpus(rng, n, first=0):
    """Two languages; a toxic text holds a form of its language's stem, most of them a form of its own."""
    plain = {"x": ["ka", "to", "mi", "ren", "su"], "y": ["sch", "ung", "ein", "gru", "zw"]}
    stems = {"x": "vilest", "y": "gemeinst"}
    rows, labels = [], []
    for i in range(first, first + n):
        lang = "xy"[int(rng.integers(5) == 0)]
        words = ["".join(rng.choice(plain[lang], rng.integers(2, 4))) for _ in range(rng.integers(10, 60))]
        toxic = int(rng.integers(3) == 0)
        for _ in range(toxic * 2):
            words[rng.integers(len(words))] = stems[lang] + "".join(rng.choice(plain[lang], 2))
        rows.append((i, " ".join(words), lang if i % 7 else None, "s"))
        labels.append((i, toxic))
    return rows, labels


def test_learned_from_labelled_rows(spark, docs, no_docs, null_docs):
    rows, labels = corpus(np.random.default_rng(8), 900)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame([*labels, (-1, 1), (3, None), (4, 9), (None, 1)], "doc_id long, toxic int")
    scorer = toxicity.learn(frame.where("doc_id < 600"), marks, steps=400)
    assert scorer.languages.names == ["x", "y"]
    truth = dict(labels)
    got = toxicity.score(frame.where("doc_id >= 600"), scorer).collect()
    assert len(got) == 300 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    for lang in "xy":
        own = [r for r in got if r["lang"] == lang]
        assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in own]) >= 0.95
    # nothing but the text is looked at
    other = toxicity.score(spark.createDataFrame([(-r[0], r[1]) for r in rows[600:700]], "doc_id long, text string"), scorer)
    assert {(-r["doc_id"], r["score"]) for r in other.collect()} == {(r["doc_id"], r["score"]) for r in got if r["doc_id"] < 700}
    # one toxic word far into a long text, past the end of a piece
    clean, toxic = next(r[1] for r, t in zip(rows, labels, strict=True) if not t[1]), "vilestkato vilestmito"
    long = [(0, f"{clean} " * 1500), (1, f"{clean} " * 1500 + toxic), (2, None), (3, "")]
    found = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(long, "doc_id long, text string"), scorer).collect()}
    assert (found[0]["predicted"], found[1]["predicted"]) == (0, 1) and found[2]["score"] == found[3]["score"]
    odd = toxicity.score(docs, scorer)
    assert odd.columns == [*docs.columns, "_score", "predicted"] and odd.count() == docs.count()
    assert toxicity.score(null_docs, scorer).count() == null_docs.count()
    assert toxicity.score(no_docs, scorer).count() == 0


def test_without_both_labels(spark, docs, no_docs):
    marks = spark.createDataFrame([(i, 1) for i in range(4)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs.drop("score"), toxicity.learn(docs, marks)).collect()} == {1.0}
    assert {r["score"] for r in toxicity.score(docs.drop("score"), toxicity.learn(no_docs, marks)).collect()} == {0.0}
    few = spark.createDataFrame([(3, 0), (4, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, few, steps=5)).count() == docs.count()


def test_sample_is_bounded_and_draws_a_copied_text_once(spark):
    rows = [(i, f"text {i % 5}" if i % 2 else f"longer text number {i} " * 20, "x") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, i % 3 % 2) for i in range(80)], "doc_id long, label int")
    whole = toxicity.sampled(frame, marks, sample_docs=100, sample_bytes=10**6)
    assert {(r[0], r[2]) for r in whole} == {(t, i % 3 % 2) for i, t, _ in rows} and len(whole) == len(set(whole))
    assert len(toxicity.sampled(frame, marks, sample_docs=3, sample_bytes=10**6)) <= 6
    assert sum(len(r[0]) for r in toxicity.sampled(frame, marks, sample_docs=100, sample_bytes=2_000)) <= 2_000


def test_registered_query_holds_out_a_fifth(spark):
    from tests.conftest import DATA
    from tideline.llm.queries import QUERIES

    got = QUERIES["op11_toxicity"](spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_every_labelled_text_counts(spark):
    """Words and cuts that stand outside the bounded start are learned from; copies count once."""
    rng = np.random.default_rng(5)
    rows, labels = corpus(rng, 900)
    labels = [(i, 1 if i >= 300 and i % 2 else t) for i, t in labels]
    rows = [(i, f"{t} zornig{i % 9}ka" if i >= 300 and i % 2 else t, *rest) for i, t, *rest in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    small = toxicity.learn(frame, marks, sample_docs=20, steps=200)
    asked = spark.createDataFrame([(k, f"{t} zornig{k % 9}ka", "x", "s") for k, (_, t, *_) in enumerate(r for r, m in zip(rows, labels, strict=True) if not m[1])], frame.schema)
    plain = spark.createDataFrame([(r[0], r[1], "x", "s") for r, m in zip(rows, labels, strict=True) if not m[1]], frame.schema)
    marked = [np.mean([r["predicted"] for r in toxicity.score(f, small).collect()]) for f in (asked, plain)]
    assert marked[0] > 0.9 and marked[1] < 0.1
    # counts of languages: all words of the texts that teach, each text once
    copies = frame.unionAll(frame.where("doc_id < 400").withColumn("doc_id", frame["doc_id"] + 5000))
    own = copies.select("doc_id", "text", "lang")
    pairs = marks.withColumnRenamed("toxic", "label")
    more = pairs.unionAll(pairs.where("doc_id < 400").selectExpr("doc_id + 5000", "label"))
    got = toxicity.texts_of(own, toxicity.labelled(own, more)).collect()
    assert sorted((r["text"], r["label"]) for r in got) == sorted({(r[1], m[1]) for r, m in zip(rows, labels, strict=True)})
    table = toxicity.Languages.learned(spark.createDataFrame([(r["text"], r["lang"]) for r in got], "text string, lang string"), ["x", "y"]).table
    n = sum(len(r["text"].split()) for r in got if r["lang"] == "x")
    assert np.exp(-table[:, 0].min()) == pytest.approx((n + 0.5 * len(table)) / 0.5, rel=1e-4)


def test_cut_by_counts():
    x, y = np.array([0.0, 1.0, 2.0, 3.0]), np.array([0, 1, 0, 1])
    counts = np.array([5, 1, 9, 30])
    assert toxicity.best_cut(x, y, counts) == toxicity.best_cut(np.repeat(x, counts), np.repeat(y, counts)) == 2.5
