"""Bands of quality rules under copies and in small languages."""

import numpy as np
import pytest

from tideline.llm import quality


def prose(rng, syllables, n):
    """Texts of two to four syllables a word, from more or fewer syllables in each text, so that perplexities differ."""
    out = []
    for _ in range(n):
        own = rng.choice(syllables, rng.integers(8, len(syllables) + 1), replace=False)
        out.append(" ".join("".join(rng.choice(own, rng.integers(2, 5))) for _ in range(rng.integers(300, 400))))
    return out


SYLLABLES = {
    "x": ["ka", "to", "mi", "ren", "su", "lo", "pa", "ne", "vi", "dor", "el", "an", "ti", "ras"],
    "y": ["sch", "ung", "ein", "gru", "zw", "pf", "ach", "ber", "eit", "kno", "ohl", "iss", "tz", "ug"],
}


def verdicts(spark, rows):
    return {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}


def test_copies_do_not_narrow_the_bands(spark):
    rng = np.random.default_rng(3)
    names = ["".join(rng.choice(list("bcdfgjkqvwxz"), 6)) for _ in range(400)]
    plain = prose(rng, SYLLABLES["x"], 80)
    texts = [" ".join(str(rng.choice(names)) if rng.random() < i / 240 else w for w in t.split()) for i, t in enumerate(plain)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(1000 + i, texts[40], "x") for i in range(300)]
    rows += [(2000 + i, t, "y") for i, t in enumerate(prose(rng, SYLLABLES["y"], 100))]
    kept = verdicts(spark, rows)
    assert all(kept[i] for i in range(80)) and all(kept[1000 + i] for i in range(300))


def test_copies_count_once_in_the_model(spark):
    texts = prose(np.random.default_rng(6), SYLLABLES["x"], 12)
    frame = spark.createDataFrame([(t,) for t in [*texts, *texts[:2] * 9, None, None]], "text string").repartition(3)
    counts = [sorted(map(tuple, quality.count_ngrams(f, "text").collect())) for f in (frame, frame.distinct())]
    assert counts[0] == counts[1]


def test_a_small_language_has_its_own_bands(spark):
    rng = np.random.default_rng(4)
    hot = [(i, t, "x") for i, t in enumerate(prose(rng, SYLLABLES["x"], 400))]
    small = prose(rng, SYLLABLES["y"], 51)
    for n in (5, 49, 51):
        kept = verdicts(spark, hot + [(1000 + i, t, "y") for i, t in enumerate(small[:n])])
        assert all(kept[1000 + i] for i in range(n))


def test_bands_narrow_smoothly(spark):
    x = np.random.default_rng(5).normal(size=400)
    large = [("a", i, float(v)) for i, v in enumerate(x)]
    widths = []
    for n in (1, 10, 49, 50, 200):
        own = np.quantile(x, (np.arange(n) + 0.5) / n)
        marks = spark.createDataFrame(large + [("b", i, float(v) + 9) for i, v in enumerate(own)], "label string, key long, x double")
        low, high = next((r["low"], r["high"]) for r in quality.bands(marks, "label", "key").collect() if r["label"] == "b")
        assert low < 9 < high
        widths.append(high - low - (np.quantile(own, 0.75) - np.quantile(own, 0.25)))
    assert widths[0] > widths[1] > widths[3] > widths[4]
    assert widths[2] == pytest.approx(widths[3], rel=0.03)


def test_bytes_of_one_symbol_are_told_apart(spark):
    """Letters of another script that fall on the same symbols, and other case, are not the language's own words."""
    rng = np.random.default_rng(8)
    letters = "абвгдеж"
    other = "".join(chr(ord(c) - 24) for c in letters)  # the same leading byte, and another of the same symbol after it
    stock = ["".join(rng.choice(list(letters), rng.integers(2, 6))) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(stock, 120)), "q") for i in range(200)]
    rows += [(900, rows[0][1].translate(str.maketrans(letters, other)), "q")]
    latin = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 6))) for _ in range(200)]
    rows += [(1000 + i, " ".join(rng.choice(latin, 120)), "r") for i in range(200)]
    rows += [(1900, "".join(c.upper() if k % 2 else c for k, c in enumerate(rows[-1][1])), "r")]
    assert rows[0][1].encode().translate(quality._FOLD) == rows[200][1].encode().translate(quality._FOLD)
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[900]["log10_prob"] < got[0]["log10_prob"] - 100
    assert not got[900]["kept"] and not got[1900]["kept"]
    assert sum(got[i]["kept"] for i in (*range(200), *range(1000, 1200))) >= 396


def test_bytes_of_a_symbol_share_its_chance(spark):
    words = ["aAbé", "éa", "b2Ç", "ab.", "ba!?", "aab"]
    spelling = quality.learn(spark.createDataFrame([(" ".join(words),)], "text string")).spelling
    symbols = np.frombuffer(quality._FOLD, np.uint8)
    for before in (b"  ", b" a", b"aA", b"\xc3\xa9", b"zz"):
        chances = 10 ** spelling.log10(np.array([before[0] << 16 | before[1] << 8 | b for b in range(256)]))
        assert np.bincount(symbols, weights=chances)[np.unique(symbols)] == pytest.approx(1, rel=1e-5)


def test_kept_rows_are_those_judged_and_texts_are_not_stored(spark, monkeypatch):
    """Equal texts under other labels are told apart, rows may repeat, and scratch holds no copy of the texts."""
    rng = np.random.default_rng(11)
    rows = [(i, t, "x", "s") for i, t in enumerate(prose(rng, SYLLABLES["x"], 80))] + [(100 + i, t, None, "s") for i, t in enumerate(prose(rng, SYLLABLES["y"], 80))]
    rows += [(300, rows[100][1], "x", "s"), (100, rows[100][1], None, "s"), (301, None, None, "s"), (302, "x", None, "s"), (303, None, "x", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, pair string").coalesce(2)
    judged = {(r["doc_id"]): r["kept"] for r in quality.judge(frame).collect()}
    tables, write = [], quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, name: tables.append(df.columns) or write(df, name))
    kept = quality.without_poor(frame)
    got = sorted((r["doc_id"], r["text"], r["lang"] or "") for r in kept.collect())
    assert got == sorted((i, t, lang or "") for i, t, lang, _ in rows if judged[i]) and kept.columns == frame.columns
    assert 1 < len(got) < len(rows)
    assert tables and not any("text" in columns for columns in tables)
