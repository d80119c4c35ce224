"""Whitening, quality rules and periodic runs against their definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_operators import FOLDER, empty, odd, table

from pagemill.llm import quality_rules, queries, runs, whitening


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ---- whitening ----

def check_whitened(rows, vectors, components=4):
    """rows of whiten() against NumPy; vectors: (vec_id, entries)."""
    usable = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in vectors
              if v and all(e is not None and math.isfinite(e) for e in v)]
    assert Counter(i for i, _ in usable) == Counter(r["vec_id"] for r in rows)
    fit = np.array(sorted({tuple(x) for _, x in usable}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    deviations = {tuple(x): int(((n * x.astype(object) - sums) ** 2).sum()) for x in fit}
    by_id = dict(usable)
    got = np.array([r["whitened"] for r in rows])
    want = (np.array([by_id[r["vec_id"]] for r in rows]) - sums / n) @ (axes[:, order] / np.sqrt(values[order]))
    assert np.allclose(got, want * np.sign((got * want).sum(axis=0)), atol=1e-9)
    for r in rows:
        assert r["n"] == n and r["deviation"] == deviations[tuple(by_id[r["vec_id"]])]
        assert np.allclose(r["explained"], values[order] / np.trace(covariance)) and r["identity_error"] < 1e-9


def test_whitening_query(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    rows = whitening.whiten(spark.read.parquet(f"{FOLDER}/embeddings.parquet")).collect()
    check_whitened(rows, vectors)
    report = queries.embedding_whitening(spark, FOLDER).collect()
    assert len(report) == 4 * len(rows)
    per = {(r["vec_id"], k + 1): w for r in rows for k, w in enumerate(r["whitened"])}
    assert all(abs(r["whitened"] - per[r["vec_id"], r["component"]]) < 1e-9 for r in report)


VECTORS = "vec_id long, embedding array<float>, label int, n long, x string"


def test_whitening_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "LEAST_VALUES", 21)  # blocks of seven rows
    draw = random.Random(4)
    scales = [3.0, 2.0, 1.0]
    good = [(i, [draw.gauss(0, s) for s in scales]) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(40)] + [(7, good[7][1])]  # copies, and a repeated row
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in good]
    odd_rows = [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [float("nan"), 0.0, 0.0]), (204, [float("inf"), 0.0, 0.0]),
                (205, [1.0, 2.0]), (206, [1e30, 0.0, 0.0])]
    df = table(spark, [(i, v, None, 5, "x") for i, v in good + odd_rows], VECTORS).repartition(5)
    rows = whitening.whiten(df, components=3).collect()
    check_whitened(rows, good, 3)
    assert whitening.whiten(df.where("false")).count() == 0 and whitening.report(df.where("false")).count() == 0


def test_whitening_without_variance(spark):
    df = table(spark, [(None, [1.0, 2.0], 0, 0, ""), (2, [1.0, 2.0], 0, 0, "")], VECTORS)
    rows = whitening.whiten(df).collect()
    assert len(rows) == 2 and all(r["whitened"] == [None, None] and r["explained"] == [0.0, 0.0] and r["identity_error"] is None for r in rows)
    flat = table(spark, [(i, [float(i), 1.0], 0, 0, "") for i in range(5)], VECTORS)
    rows = whitening.whiten(flat).collect()
    assert {r["identity_error"] < 1e-12 for r in rows} == {True} and all(r["whitened"][1] is None for r in rows)


def test_deviation_beyond_64_bits():
    x = np.array([[2**40, 0], [1, 1]])
    sums = np.array([2**40 + 1, 1], object)
    exact = [sum((2 * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening._deviation(x, 2, sums) == [v if v < 2**63 else None for v in exact] and None in whitening._deviation(x, 2, sums)


# ---- quality rules ----

def plain_rules(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed)


def plain_judge(rows, trusted, buckets):
    def grams(text):
        hashes = [zlib.crc32(w.encode()) for w in words_of(text)]
        return [h % buckets for h in hashes] + [(a * 1_000_003 + b * 7_919) % 4_294_967_291 % buckets for a, b in zip(hashes, hashes[1:])]

    raw, own = Counter(), Counter()
    for doc_id, text in rows:
        raw.update(grams(text))
        if doc_id in trusted:
            own.update(grams(text))
    share = quality_rules.SHARE
    totals = [sum(c.values()) + share * buckets for c in (raw, own)]
    ratio = [math.floor(1e6 * math.log((own[b] + share) / totals[1] / ((raw[b] + share) / totals[0])) + 0.5) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        own_grams = grams(text)
        total, base = sum(ratio[b] for b in own_grams), plain_rules(text)
        score = total / len(own_grams) / 1e6 if own_grams else None
        out.append((doc_id, *base, None if score is None else round(score, 9), not base[-1] and total >= quality_rules.LEAST_RATIO * len(own_grams)))
    return Counter(out)


def judged(spark, docs, trusted):
    rows = quality_rules.judge(docs, table(spark, [(i,) for i in trusted], "doc_id long")).collect()
    return Counter((*r[:7], None if r["score"] is None else round(r["score"], 9), r["kept"]) for r in rows)


def test_rules_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "BUCKETS", 64)
    draw = random.Random(8)
    texts = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(draw.randint(0, 90))) for _ in range(40)]
    texts += ["a b c d e f g h " * 9, "w " * 50, "x\x1cy z \x0b\x0c#*$%&|<>\n\nq\n q\nq\n" * 8, "é😀 " * 25]
    docs = odd(spark, [(10 + i, t, "en", None, 1) for i, t in enumerate(texts)])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    trusted = [10, 11, 12, 13, 5, 5, None, 999]
    want = plain_judge(rows, set(trusted) - {None}, 64)
    assert judged(spark, docs, trusted) == want
    monkeypatch.setattr(quality_rules, "BROADCAST_IDS", 1)
    assert judged(spark, docs, trusted) == want
    assert judged(spark, docs, []) == plain_judge(rows, set(), 64)
    assert quality_rules.judge(empty(spark), table(spark, [], "doc_id long")).count() == 0


def test_rules_keep_a_text_at_the_bounds(spark):
    """Exactly 20 words and exactly 30 % repeated words pass, and a score of exactly zero is kept."""
    words = " ".join(f"w{i}" for i in range(20))
    window = " ".join(f"r{i}" for i in range(9))
    third = " ".join([window, *(f"u{i}" for i in range(42)), window])  # 18 of 60 words
    docs = table(spark, [(1, words), (2, words.rsplit(" ", 1)[0]), (3, third), (4, third.replace("u0 ", ""))])
    rows = {r["doc_id"]: r for r in quality_rules.judge(docs, table(spark, [], "doc_id long")).collect()}
    assert [rows[i]["base_failed"] for i in (1, 2, 3, 4)] == [False, True, False, True]
    assert rows[3]["n_repeat_words"] == 18 and not any(rows[i]["kept"] for i in (2, 4))
    own = quality_rules.judge(docs.where("doc_id = 1"), docs.where("doc_id = 1")).collect()[0]
    assert own["score"] == 0 and own["kept"]


def test_rules_keep_good_texts_and_drop_bad_ones(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    # Trusted are half of the good ones; the others were not seen by the target model.
    trusted = labels.where("quality = 1 and doc_id % 2 = 0")
    rows = quality_rules.judge(docs, trusted).join(labels, "doc_id").where("not base_failed and doc_id % 2 = 1").collect()
    kept = {q: [r["kept"] for r in rows if r["quality"] == q] for q in (0, 1)}
    assert sum(kept[1]) > 0.98 * len(kept[1]) and sum(kept[0]) < 0.2 * len(kept[0])


# ---- periodic runs ----

def plain_runs(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            smallest = not any(all(words[k] == words[k + p] for k in range(begin, end - p)) for p in range(1, q))
            if end - begin >= max(6, 4 * q) and smallest:
                out.append((begin, end - begin, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_definition():
    draw = random.Random(2)
    for _ in range(600):
        n, letters = draw.randrange(110), draw.choice([1, 2, 2, 3, 5, 60])
        words = [draw.randrange(letters) for _ in range(n)]
        for _ in range(draw.randrange(3)):
            if n > 8:
                a, p = draw.randrange(n - 4), draw.randrange(1, n // 3 + 1)
                for i in range(a + p, draw.randrange(a, n)):
                    words[i] = words[i - p]
        assert [tuple(r) for r in runs.find_runs(np.array(words, np.int64)).tolist()] == plain_runs(words)


@pytest.mark.parametrize("order", [0, 1, 4, 9])
def test_transform_gives_exact_products(order):
    transform, size, draw = runs.Transform(order), 1 << order, np.random.default_rng(order)
    a, b = (draw.integers(0, 1 << 12, (3, size)).astype(np.uint64) for _ in range(2))
    got = transform.inverse(transform.forward(a) * transform.forward(b) % np.uint64(runs.PRIME))
    for row in range(3):
        plain = np.zeros(size, object)
        for i in range(size):
            plain += np.roll(b[row].astype(object), i) * int(a[row, i])
        assert (got[row].astype(object) == plain % runs.PRIME).all()
    assert (transform.inverse(transform.forward(a)) == a).all()


def test_occurrences_of_large_word_numbers():
    """Word numbers of several digits, whose squared differences would pass the prime."""
    words = np.array([5_000_000, 1, 7, 5_000_000, 1, 7, 5_000_000, 1, 7, 9, 9, 9, 0, 0, 0, 0], np.int64)
    seeds, distances = runs.occurrences(words, np.array([0, 2]), 2)
    assert sorted(zip(seeds.tolist(), distances.tolist())) == [(0, 3), (2, 3)]


def test_runs_of_long_texts():
    """Texts on which naive extension would be quadratic."""
    for words, want in ((np.zeros(60_000, np.int64), [[0, 60_000, 1]]), (np.tile(np.arange(9_000), 5), [[0, 45_000, 9_000]]),
                        (np.concatenate((np.zeros(20_000, np.int64), [1], np.zeros(20_000, np.int64))), [[0, 20_000, 1], [20_001, 20_000, 1]])):
        assert runs.find_runs(words).tolist() == want


def plain_report(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    text = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    values = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *values, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_query(spark):
    """Every document of the table whose definition takes no more than some seconds."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = {r["doc_id"]: tuple(r) for r in queries.periodic_runs(spark, FOLDER).collect()}
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        if len(words_of(text)) < 1_500:
            assert rows[doc_id] == plain_report(doc_id, text)


def test_runs_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(runs, "CHUNK_WORDS", 40)
    extra = [(10 + i, t, None, None, None) for i, t in enumerate(
        ["a b c d e " * k for k in range(1, 9)] + ["a a a a a", "a a a a a a", "x y " * 4 + "z " * 9, "é è " * 6, "a\x1cb " * 6, "p q r " * 4])]
    docs = odd(spark, [(k, t, *r) for k, t, *r in extra])
    want = Counter(plain_report(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in (4,))
    got = Counter(tuple(r) for r in runs.report(docs).collect() if r["doc_id"] not in (4,))
    assert got == want
    long = [r for r in runs.report(docs.where("doc_id = 4")).collect()]
    assert [(r["n_runs"], r["length"], r["period"]) for r in long] == [(1, 30_000, 1)]
    whole = runs.periodic_runs(docs.withColumn("runs", docs["doc_id"]))
    assert whole.columns.count("runs") == 1 and whole.count() == docs.count()
    assert runs.report(empty(spark)).count() == 0
