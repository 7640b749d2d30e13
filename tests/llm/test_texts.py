"""Language identification, span dedup and quality rules against plain rules."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tideline.llm import language_id, quality, span_dedup

# Language identification ------------------------------------------------------------------------


def test_gradients_match_differences():
    net = language_id.Gru(3, hidden=4, embed=3, seed=2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    bytes_, lengths = language_id.padded([b"abc", b"d", b"efghi"])
    labels = np.array([0, 2, 1])
    _, grads = net.gradients(bytes_, lengths, labels)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        for _ in range(4):
            at = tuple(rng.integers(s) for s in g.shape)
            if name == "E":
                at = (int(bytes_[0, rng.integers(3)]), at[1])
            keep, eps = net.p[name][at], 1e-2
            net.p[name][at] = keep + eps
            up = net.gradients(bytes_, lengths, labels)[0]
            net.p[name][at] = keep - eps
            down = net.gradients(bytes_, lengths, labels)[0]
            net.p[name][at] = keep
            assert g[at] == pytest.approx((up - down) / (2 * eps), abs=2e-3)


def test_padding_and_batches_do_not_matter():
    net = language_id.Gru(3)
    model = language_id.Identifier(["a", "b", "c"], net, 24)
    words = [b"one", b"a-much-longer-word-that-is-cut-in-pieces-" * 3, "é".encode(), b"x"]
    together = model.of_words(words)
    for w, row in zip(words, together, strict=True):
        assert model.of_words([w])[0] == pytest.approx(row, abs=1e-5)
        assert row[:-1].sum() == pytest.approx(row[-1], rel=1e-5)


def test_language_learned_from_labelled_rows(spark, docs, no_docs, null_docs):
    rng = np.random.default_rng(4)
    syllables = {"x": ["ka", "to", "mi"], "y": ["sch", "ung", "ein"]}
    rows = []
    for i in range(300):
        lang = "xy"[i % 2]
        rows.append((i, " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(20)), lang if i % 5 else None))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(frame.where("doc_id < 200"), steps=60)
    got = language_id.identify(frame.where("doc_id >= 200"), model).collect()
    assert all(r["lang_pred"] == "xy"[r["doc_id"] % 2] and 0 <= r["score"] <= 1 for r in got)
    odd = language_id.identify(docs.select("doc_id", "text"), model).collect()
    assert len(odd) == docs.count()
    assert {r["lang_pred"] for r in odd if not re.search(r"[^\W\d_]", r["text"] or "")} == {"und"}
    assert {r["lang_pred"] for r in odd if re.search(r"[^\W\d_]", r["text"] or "")} <= {"x", "y"}
    untaught = language_id.learn(no_docs)
    assert {r["lang_pred"] for r in language_id.identify(docs.select("doc_id", "text"), untaught).collect()} == {"und"}
    assert language_id.identify(null_docs.select("doc_id", "text"), model).count() == null_docs.count()
    single = language_id.learn(frame.where("lang = 'x'"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(frame.limit(3), single).collect()} == {("x", 1.0)}


# Spans ------------------------------------------------------------------------------------------


def plain_removed(rows, least_sentences=2, least_words=20):
    """(doc_id, text) -> sentences removed, by comparing the words of every span."""
    where = defaultdict(list)
    for key in {(i, t) for i, t in rows if i is not None and t}:
        parts = [tuple(w) for _, w in span_dedup.sentences(key[1].encode())]
        for first in range(len(parts)):
            for end in range(first + least_sentences, len(parts) + 1):
                if sum(map(len, parts[first:end])) >= least_words:
                    where[tuple(parts[first:end])].append((key, first, end))
                    break
    gone = defaultdict(set)
    for places in where.values():
        if len(places) > 1:
            keep = min(places, key=lambda p: (p[0][0], text_key(p[0][1]), p[1]))
            for key, first, end in places:
                if (key, first, end) != keep:
                    gone[key].update(range(first, end))
    return gone


def text_key(text):
    import xxhash

    h = xxhash.xxh64_intdigest(text.encode())
    return h - (1 << 64) if h >> 63 else h


def test_sentences_make_up_the_text(docs):
    for r in docs.collect():
        text = (r["text"] or "").encode()
        assert b"".join(p for p, _ in span_dedup.sentences(text)) == text


def test_spans_equal_plain_rule(spark, docs):
    rng = np.random.default_rng(8)
    bank = [" ".join(f"w{x}" for x in rng.integers(0, 400, rng.integers(3, 40))) + "." for _ in range(30)]
    texts = [" ".join(rng.choice(bank, rng.integers(1, 12))) for _ in range(40)]
    passage = " ".join(f"q{i}" for i in range(80))
    texts += [f"Some words before it {passage} and after", f"Other {passage}. End."]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([*enumerate(texts, 100), (None, texts[0]), (100, texts[0])], "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    gone = plain_removed(rows)
    got = span_dedup.dedup_spans(frame).collect()
    want = Counter()
    for i, t in rows:
        parts = span_dedup.sentences((t or "").encode())
        drop = gone[i, t] if i is not None else set()
        want[i, None if t is None else b"".join(p for k, (p, _) in enumerate(parts) if k not in drop).decode(), len(parts), len(drop)] += 1
    assert Counter((r["doc_id"], r["text"], r["n_sentences"], r["n_removed"]) for r in got) == want
    assert sum(len(d) for d in gone.values()) > 50
    assert next(r for r in got if r["doc_id"] == 141)["n_removed"] > 0  # the passage without sentence ends
    assert next(r for r in got if r["doc_id"] == 141)["first_docs"] == [140]


def test_spliced_passages_of_51_words_lose_their_copy(spark):
    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join(f"v{x}" for x in rng.integers(0, 100_000, n))

    rows = []
    for k in range(400):
        passage = prose(51)
        ends = [rng.choice(["", ".", "!"]) + rng.choice([" ", "\n"]) for _ in range(2)]
        rows += [(2 * k, f"{prose(30)}{ends[0]}{passage} {prose(30)}"), (2 * k + 1, f"{prose(17)} {passage}{ends[1]}{prose(9)}")]
    clean = [(10_000 + k, prose(90)) for k in range(100)]
    got = {r["doc_id"]: r["n_removed"] for r in span_dedup.dedup_spans(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    assert all(got[2 * k + 1] > 0 and got[2 * k] == 0 for k in range(400))
    assert not any(got[i] for i, _ in clean)


def test_pieces_of_many_texts_are_those_of_each(docs):
    texts = [None if r["text"] is None else r["text"].encode() for r in docs.collect()] + [b"A b. c", b"same " * 3000, b"\xc3\xa9. 3.14 x!\n\n y " * 70]
    assert span_dedup.sentence_counts(texts) == [len(span_dedup.sentences(t or b"")) for t in texts]
    assert max(len(words) for t in texts for _, words in span_dedup.sentences(t or b"")) <= 8
    at, first, end, h1, h2 = span_dedup.Pieces(texts, 8).spans(2, 20)
    by_words = {}
    for t, a, b, *h in zip(at, first, end, h1.tolist(), h2.tolist(), strict=True):
        by_words.setdefault(tuple(tuple(w) for _, w in span_dedup.sentences(texts[t])[a:b]), set()).add(tuple(h))
    assert all(len(h) == 1 for h in by_words.values()) and len({h for hs in by_words.values() for h in hs}) == len(by_words)


def test_spans_of_nothing(no_docs, null_docs):
    assert span_dedup.dedup_spans(no_docs).count() == 0
    assert [r["n_removed"] for r in span_dedup.dedup_spans(null_docs).collect()] == [0, 0, 0]


# Quality ----------------------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_counts_equal_plain_rules(docs, spark, null_docs, no_docs):
    rng = np.random.default_rng(2)
    extra = [" ".join(rng.choice(["a", "b", "#c"], 60)) for _ in range(10)] + ["x y z\n" * 9 + "é ü"]
    frame = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(i, t, "z") for i, t in enumerate(extra, 100)], "doc_id long, text string, lang string"))
    got = quality.judge(frame).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = Counter((r["doc_id"], *plain_counts(r["text"])) for r in frame.collect())
    assert Counter((r["doc_id"], *(r[c] for c in names)) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.judge(no_docs).count() == 0
    assert not any(r["kept"] for r in quality.judge(null_docs).collect())
    kept = quality.without_poor(frame)
    assert kept.columns == frame.columns and kept.count() == sum(r["kept"] for r in got)


def plain_kneser_ney(words):
    """Interpolated modified Kneser-Ney from its formulas; returns log10 p(word, edge included)."""
    grams = {n: Counter() for n in range(1, 5)}
    for w, times in Counter(words).items():
        s = [0, 0, 0, *w.translate(quality._FOLD), 0]
        for i in range(3, len(s)):
            grams[4][tuple(s[i - 3 : i + 1])] += times
    for n in (3, 2, 1):
        for g in grams[n + 1]:
            grams[n][g[1:]] += 1
    discounts = {n: quality._discounts(np.array(list(grams[n].values()))) for n in grams}

    def prob(g):
        if not g:
            return 1 / 64
        n = len(g)
        below = prob(g[1:])
        around = [c for x, c in grams[n].items() if x[:-1] == g[:-1]]
        if not around:
            return below
        c, d = grams[n][g], discounts[n]
        return (c - d[min(c, 3)] + sum(d[min(x, 3)] for x in around) * below) / sum(around)

    return lambda w: sum(math.log10(prob(tuple(s[i - 3 : i + 1]))) for s in [[0, 0, 0, *w.translate(quality._FOLD), 0]] for i in range(3, len(s)))


def test_model_equals_formulas(spark):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcde.É"), rng.integers(1, 7))) for _ in range(300)]
    frame = spark.createDataFrame([(i, " ".join(words[i::3])) for i in range(3)], "doc_id long, text string")
    model = quality.learn(frame)
    plain = plain_kneser_ney([w.encode() for w in words])
    asked = [w.encode() for w in [*words[:20], "zzz", "abcabcabcabc", "###"]]
    for w, row in zip(asked, model.of_words(asked), strict=True):
        assert row[0] == pytest.approx(plain(w), rel=1e-5)
    every = np.arange(64)
    for context in (0, 1 << 6 | 2, 5 << 12 | 63):
        assert (10 ** model.log10(context << 6 | every)).sum() == pytest.approx(1, rel=1e-5)


def test_odd_texts_leave_the_bands(spark):
    rng = np.random.default_rng(6)
    stock = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 6))) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(stock, 120)), "q") for i in range(200)] + [(900, " ".join("".join(rng.choice(list("zqxjkvw9"), 6)) for _ in range(120)), "q"), (901, " ".join(rng.choice(stock[:3], 120)), "q")]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[900] and sum(got[i] for i in range(200)) >= 198
