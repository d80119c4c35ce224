"""Each operator against its definition, and on nulls, empty and long texts, repeated rows and empty tables."""

import hashlib
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from pagemill.llm import (
    bpe, components, decontamination, graphs, language_model, licenses, lines, minhash, quality, queries, simhash, substring, toxicity)

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, n_lines int, simhash int, score string"


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def odd(spark, extra=()):
    """Nulls in every column, empty, blank and long texts, repeated rows, names that the operators use themselves."""
    rows = [(1, None, None, None, None), (None, "a b c d e f", "en", "s1", 3), (2, "", "en", None, 0), (3, " \t\n ", None, "s2", 4),
            (4, "word " * 30_000, "en", "s1", 1), (5, "a b c d e f", "en", "s1", 3), (5, "a b c d e f", "en", "s1", 3),
            (6, "x" * 100_000, "en", "s3", 1), (None, None, None, None, None), *extra]
    return table(spark, [(*r, "i", 1, 2, "s") for r in rows], SCHEMA)


def empty(spark):
    return odd(spark).where("false")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# ---- byte-level BPE ----

@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_library(encoding):
    own = bpe.codec(RANKS, public_tokenizers.PATTERN)
    draw = random.Random(5)
    letters = "ab  \n\t é'sßtheing1239 　😀日\x1c\x85.,!<|>"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(3_000)]
    texts += ["a" * 20_000, "ab" * 9_000, " " * 3_000, "=" * 3_000, "<|endoftext|>", "qu'il n't"]
    for text in texts:
        ids = encoding.encode_ordinary(text)
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
        assert own.decode(own.encode(text)) == text.encode()


def test_bpe_memory_is_bounded(monkeypatch, encoding):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 40 * 220)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 30)
    own = bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    text = " ".join(f"word{i % 97} x{i}" for i in range(2_000))
    ids = encoding.encode_ordinary(text)
    assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert len(own.chunks) <= 20 and len(own.pieces) <= 20 and len(own.fits) <= 30
    own.forget(kept=True)
    assert own.old_chunks and not (own.chunks or own.pieces or own.old_pieces)
    assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    own.forget()
    assert not (own.chunks or own.old_chunks or own.pieces or own.old_pieces or own.fits)


def test_bpe_query(spark, documents, encoding):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for r in queries.byte_bpe(spark, FOLDER).collect():
        ids = encoding.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_odd_rows(spark):
    out = bpe.encode_decode(odd(spark), RANKS, public_tokenizers.PATTERN)
    rows = out.collect()
    assert len(rows) == 9 and out.columns.count("ids") == 1
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)
    assert bpe.encode_decode(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


# ---- SimHash and components ----

def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_simhash_query(spark, documents):
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in documents.collect()}
    ids = sorted(prints)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = union(ids, pairs)
    got = {r["doc_id"]: r for r in queries.simhash_near_dedup(spark, FOLDER).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["fingerprint"] == f"{prints[i]:016x}" for i, r in got.items())


def test_simhash_links_are_complete(spark):
    draw = random.Random(1)
    values = {draw.getrandbits(64) for _ in range(50)}
    for v in list(values):
        for _ in range(8):
            for bit in draw.sample(range(64), draw.randrange(1, 5)):
                v ^= 1 << bit
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    got = simhash.links(table(spark, [(v,) for v in signed], "simhash long")).collect()
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)


def joins(df):
    """The joins that ran, with their keys."""
    df.collect()
    return re.findall(r"(?:BroadcastHash|SortMerge|ShuffledHash)Join \[[^]]*\]", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])


def test_simhash_keys_are_not_broadcast(spark):
    """A fingerprint has 28 keys, which Spark takes for one row, so a table that seems small would fill the driver."""
    prints = spark.range(200).select(F.xxhash64(F.floor(F.col("id") / 2)).bitwiseXOR(F.col("id") % 2).alias("simhash"))
    found = [j for j in joins(simhash.links(prints)) if "part" in j]
    assert len(found) == 1 and found[0].startswith("SortMerge")


def test_simhash_odd_rows(spark):
    rows = simhash.near_duplicates(odd(spark)).collect()
    assert len(rows) == 9
    blank = [r for r in rows if r["simhash"] == 0]
    assert {r["component_id"] for r in blank} == {1} and len(blank) == 4
    kept = simhash.one_of_each(odd(spark))
    assert kept.columns == odd(spark).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, None, None, 4, 5, 6])
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.one_of_each(empty(spark)).count() == 0


def test_one_of_each_keeps_texts_without_copies(spark):
    """Rows that share a doc_id but not the text, and columns that bear the names used inside."""
    rows = [(2, "a b c d e f", 1, "x"), (1, "q r s t u v", 2, "x"), (1, "a b c d e f", 9, "x"), (1, "a b c d e f", 9, "x"),
            (1, "a b c d e f", 8, "y"), (None, "q r s t u v", 3, "x")]
    docs = table(spark, rows, "doc_id long, text string, version int, rest string").withColumn("_id", F.lit(1)).withColumn("c0", F.lit(2))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect())
    assert found == [(0, "q r s t u v"), (1, "a b c d e f"), (1, "q r s t u v")]
    again = simhash.one_of_each(docs.repartition(7))
    assert sorted(map(str, kept.collect())) == sorted(map(str, again.collect()))


@pytest.mark.parametrize("pairs", [
    [], [(1, 1)], [(None, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)],
    [(i, (i * 7) % 40 + 1) for i in range(40)] + [(100, 101), (101, 100)]])
def test_components(spark, pairs):
    got = {r["node"]: r["component"] for r in components.connected_components(table(spark, pairs, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in pairs if None not in (a, b) and a != b]
    assert got == union({n for p in real for n in p}, real)


# ---- toxicity ----

def test_toxicity_held_out(spark):
    """On the larger tables: fitted on labels that are not held out, right on those that are."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    some = docs.join(labels.where(toxicity.held_out()), "doc_id", "left_semi")
    rows = toxicity.score(some.select("doc_id", "text"), toxicity.fit(docs, labels)).join(labels, "doc_id").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == t] for t in (1, 0))
    assert np.mean(np.array(toxic) >= 0.5) > 0.8 and np.mean(np.array(clean) >= 0.5) < 0.02


def test_toxicity_odd_rows(spark):
    labels = table(spark, [(1, 1), (5, 0), (None, 1), (4, None), (5, 1)], "doc_id long, toxic int")
    rows = toxicity.report(odd(spark), labels).collect()
    assert len(rows) == 9 and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in rows)
    assert toxicity.report(empty(spark), labels.where("false")).count() == 0
    assert toxicity.ordinary_only(odd(spark), labels).columns == odd(spark).columns
    bad, good = [f"the {w} of a day number {i}" for i in range(40) for w in ("scumbag", "wretched")], [f"the day of a number {i} is fine" for i in range(80)]
    model = toxicity.fit_texts(bad, good)
    scores = {r["text"]: r["score"] for r in toxicity.score(table(spark, [(1, "wretched scumbag"), (2, "fine day"), (3, None), (4, "")]), model).collect()}
    assert scores["wretched scumbag"] > 0.5 > scores["fine day"] and scores[None] == scores[""] < 0.5


# ---- lines ----

def test_boilerplate_lines(spark):
    common = "shared line"
    rows = [(i, f"own {i}\n{common}\nend {i}\n", f"s{i}") for i in range(12)] + [(20, f"near\n{common}x", "a"), (21, f"{common}x", "a")]
    rows += [(30, "same site", "z")] * 30 + [(None, common, None), (40, None, "q"), (41, "", "q"), (42, "\n\n", None)]
    docs = table(spark, rows, "doc_id long, text string, source string")
    out = {(r["doc_id"], r["text"]): r for r in lines.remove_boilerplate(docs).collect()}
    assert out[0, f"own 0\n{common}\nend 0\n"]["n_removed"] == 0  # the first one stays
    assert all((i, f"own {i}\nend {i}\n") in out for i in range(1, 12))
    assert out[None, ""]["n_removed"] == 1 and out[40, None]["n_lines"] == 0 and out[42, "\n\n"]["n_lines"] == 3
    assert (20, f"near\n{common}x") in out and (30, "same site") in out
    few = lines.remove_boilerplate(docs, min_sites=13).where("n_removed > 0").count()
    assert few == 0  # 12 sites are one too few: counted exactly
    clashing = docs.withColumn("gone", F.lit(1)).withColumn("gone_id", F.lit(2)).withColumn("version", F.lit(3)).withColumn("lines", F.lit(4))
    assert Counter((r["doc_id"], r["text"], r["gone"], r["lines"]) for r in lines.remove_boilerplate(clashing).collect()) == Counter(
        (r["doc_id"], r["text"], 1, 4) for r in lines.remove_boilerplate(docs).collect())
    assert lines.remove_boilerplate(odd(spark)).count() == 9 and lines.remove_boilerplate(empty(spark)).count() == 0


def test_first_places_of_many_lines_are_not_broadcast(spark):
    """Each line's first place is repeated for all pieces, which Spark takes for one row."""
    docs = table(spark, [(i, "\n".join(f"line {k}" for k in range(5_000)), f"s{i}") for i in range(lines.MIN_SITES)], "doc_id long, text string, source string")
    cleaned = lines.remove_boilerplate(docs)
    assert sum(r["n_removed"] for r in cleaned.collect()) == 5_000 * (lines.MIN_SITES - 1)
    found = [j for j in joins(cleaned) if "piece" in j]
    assert len(found) == 1 and found[0].startswith("SortMerge")


# ---- substrings ----

def plain_removal(rows, size=13):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def test_substrings(spark):
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join([*(f"w{draw.randrange(9)}" for _ in range(draw.randrange(40))), passage[draw.randrange(50):], "tail"])) for i in range(60)]
    rows += [(70, "a " * 400), (71, "a " * 12), (72, "a " * 13), (2**60 + 1, passage), (2**60, passage), (None, passage), (80, None), (81, ""), (70, "a " * 400)]
    got = substring.remove_repeats(table(spark, rows), block_bytes=500, slice_windows=50).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_removal(rows)
    got = substring.remove_repeats(odd(spark)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_removal([(r["doc_id"], r["text"]) for r in odd(spark).collect()])
    assert substring.remove_repeats(empty(spark)).count() == 0


# ---- short texts in long ones ----

def plain_contained(docs, items, share=0.8):
    def shingles(text):
        words = [w for w in __import__("regex").split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
        return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    held = [(i, shingles(t)) for i, t in docs]
    return {(i, n, len(s & d), len(s)) for i, d in held for n, s in ((n, shingles(t)) for n, t in items) if s and len(s & d) >= share * len(s)}


@pytest.mark.parametrize("bands", [minhash.BANDS, None])
def test_contained(spark, bands):
    draw = random.Random(9)
    filler = lambda n: " ".join(f"f{draw.randrange(10**6)}" for _ in range(n))
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in (3, 5, 6, 8, 9, 12, 20, 36, 70, 140)]
    docs = [(n, f"{filler(draw.randrange(900))} {t.upper()}! {filler(300)}") for n, t in items]
    docs += [(1000 + n, f"{filler(50)} {t} {filler(5000)}") for n, t in items] + [(2000, "i3x0 i3x1, i3x2"), (None, items[5][1]), (3000, None), (3001, "")]
    docs += [(4000 + n, " ".join(t.split()[: n - n // 8])) for n, t in items]
    got = minhash.contained(table(spark, docs), table(spark, [*items, (None, "x"), (999, None), (998, " ")], "item long, text string"),
                            "doc_id", "item", bands=bands).collect()
    assert {(r["doc_id"], r["item"], r["n_found"], r["n_item"]) for r in got} == plain_contained(docs, items)
    assert len(got) == len({(r["doc_id"], r["item"]) for r in got})


def test_short_texts_odd_rows(spark):
    bench = table(spark, [(1, "a b c d e f"), (None, "a"), (2, None)], "item_id long, text string")
    got = decontamination.contaminated(odd(spark), bench).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["5", "None"]
    left = decontamination.decontaminated(odd(spark), bench)
    assert left.columns == odd(spark).columns and left.where("doc_id = 5").count() == 0 and left.count() == 7
    assert decontamination.contaminated(odd(spark), bench.where("false")).count() == 0
    assert decontamination.contaminated(empty(spark), bench).count() == 0
    assert licenses.license_matches(odd(spark)).count() == 0


# ---- quality ----

def test_quality(spark):
    """EM tells good labellers from one that votes at random, and the scorer agrees with the labels."""
    draw = np.random.default_rng(2)
    truth = draw.random(4_000) < 0.8
    votes = np.stack([np.where(draw.random(4_000) < right, truth, ~truth) for right in (0.9, 0.85, 0.8, 0.5)], axis=1).astype(int)
    found = quality.expectation_maximisation(Counter((votes @ 3 ** np.arange(4)).tolist()), ["a", "b", "c", "noise"])
    accuracy = found.accuracies()
    assert accuracy["a"] > 0.85 and accuracy["b"] > 0.8 and 0.4 < accuracy["noise"] < 0.6
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs).join(labels, "doc_id").collect()
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1]) > 0.95
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) < 0.3


def test_quality_odd_rows(spark):
    assert quality.classify(odd(spark)).count() == 9
    assert quality.classify(empty(spark)).count() == 0


# ---- language models ----

def test_language_model(spark):
    draw = random.Random(4)
    texts = {i: " ".join(draw.choice("the of and to in cat dog".split() if i % 2 else "the of sun sea sky".split()) for _ in range(draw.randrange(40))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "only new words"}
    target = [i for i in texts if i % 2 and texts[i]]
    got = {r["doc_id"]: r for r in language_model.score(table(spark, list(texts.items())), table(spark, [(i,) for i in [*target, None]], "doc_id long"), 8).collect()}
    count = Counter(w for t in texts.values() for w in (t or "").split())
    known = set(sorted(count, key=lambda w: (-count[w], w))[:7])
    shown = {i: [w if w in known else "?" for w in (t or "").split()] for i, t in texts.items()}

    def model(ids):
        pairs, one, after = Counter(), Counter(), Counter()
        for i in ids:
            for a, b in zip(["?", *shown[i]], shown[i]):
                pairs[a, b] += 1
                one[b] += 1
                after[a] += 1
        base = lambda b: 0.25 * one[b] / sum(one.values()) + 0.05 / language_model.VOCABULARY
        return lambda a, b: math.log(0.7 * pairs[a, b] / after[a] + base(b) if after[a] else base(b) / 0.3)

    background, near = model(texts), model(target)
    for i, words in shown.items():
        assert got[i]["n_tokens"] == len(words)
        want = np.mean([background(a, b) - near(a, b) for a, b in zip(["?", *words], words)]) if words else None
        assert got[i]["loss_difference"] == (pytest.approx(want, abs=1e-4) if words else None)
    none = table(spark, [], "doc_id long")
    assert language_model.score(odd(spark), none).count() == 9 and language_model.score(empty(spark), none).count() == 0


def test_language_model_of_all_words(spark):
    """Words beyond any fixed number, and very long ones, keep their own counts."""
    draw = random.Random(5)
    texts = {i: " ".join(f"w{draw.randrange(6000)}" for _ in range(300)) for i in range(40)} | {40: "x" * 900 + " w1", 41: "y" * 900 + " w1", 42: None}
    target = [i for i in texts if i % 2 == 0]
    got = {r["doc_id"]: r for r in language_model.score(table(spark, list(texts.items())), table(spark, [(i,) for i in target], "doc_id long")).collect()}
    number = len({w for t in texts.values() for w in (t or "").split()}) + 1
    assert number > 2 * language_model.VOCABULARY

    def model(ids):
        pairs, one, after = Counter(), Counter(), Counter()
        for i in ids:
            own = (texts[i] or "").split()
            for a, b in zip(["", *own], own):
                pairs[a, b] += 1
                one[b] += 1
                after[a] += 1
        base = lambda b: 0.25 * one[b] / sum(one.values()) + 0.05 / number
        return lambda a, b: math.log(0.7 * pairs[a, b] / after[a] + base(b) if after[a] else base(b) / 0.3)

    background, near = model(texts), model(target)
    for i, text in texts.items():
        own = (text or "").split()
        want = np.mean([background(a, b) - near(a, b) for a, b in zip(["", *own], own)]) if own else None
        assert got[i]["loss_difference"] == (pytest.approx(want, abs=1e-9) if own else None)


# ---- vectors ----

def plain_links(rows, cosine=0.9):
    out = {}
    for i, (a, v) in enumerate(rows):
        ok = a is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        out[i] = np.array(v) / np.linalg.norm(v) if ok else None
    return [(i, j) for i in out for j in out if i < j and out[i] is not None and out[j] is not None
            and len(out[i]) == len(out[j]) and rows[i] != rows[j] and out[i] @ out[j] >= cosine]


def test_vectors(spark):
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(30, 16))
    vectors = np.concatenate([c + draw.normal(size=(20, 16)) * s for c, s in zip(centres, np.linspace(0.02, 0.6, 30))]).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(900 + k, rows[0][1]) for k in range(40)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [math.nan] * 16), (1004, [None] + [1.0] * 15), (1005, [math.inf] * 16), (None, rows[0][1]), (1006, [1.0, 2.0]), rows[5]]
    got = graphs.near_duplicates(table(spark, [(a, v, 1) for a, v in rows], "vec_id long, embedding array<float>, node int")).collect()
    assert len(got) == len(rows)
    pairs = plain_links(rows)
    degree, distinct = Counter(), {(min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0])) for i, j in pairs}
    for a, b in distinct:
        degree[a] += 1
        degree[b] += 1
    found = sum(r["n_links"] for r in {r["vec_id"]: r for r in got}.values())
    assert 0.97 * 2 * len(distinct) <= found <= 2 * len(distinct)
    want = union({a for a, _ in rows if a is not None}, distinct)
    named = {r["vec_id"]: r for r in got if r["vec_id"] is not None}
    assert np.mean([named[a]["component_id"] == c for a, c in want.items()]) > 0.97
    for odd_id in range(1000, 1007):
        assert named[odd_id]["n_links"] == 0 and named[odd_id]["kept"]
    assert graphs.near_duplicates(table(spark, [], "vec_id long, embedding array<float>")).count() == 0


def test_graph_widens_its_beam():
    """A cluster far larger than the beam is found whole."""
    draw = np.random.default_rng(8)
    near = graphs.unit(np.concatenate((draw.normal(size=8) * 4 + draw.normal(size=(700, 8)) * 0.05, draw.normal(size=(300, 8)))))
    graph = graphs.build(near[draw.permutation(1000)])
    i, j = graphs.links(graph, graph.vectors, 0.9, 32)
    true = (graph.vectors @ graph.vectors.T >= 0.9).sum()
    assert len(i) >= 0.97 * true


def test_audit_sees_lost_links():
    """A graph without edges finds nothing but entries: a node's link with itself does not hide that, and the beam takes in all."""
    draw = np.random.default_rng(9)
    graph = graphs.build(graphs.unit(draw.normal(size=(400, 16))))
    width, true, found, hit = graphs.audited(graph, 0.9)
    assert width < 400 and true >= 128 and found >= 0.99 * true and hit >= 0.9
    broken = graphs.Graph(graph.vectors, [np.full_like(x, -1) for x in graph.layers], graph.entry)
    width, true, found, hit = graphs.audited(broken, 0.9)
    assert width == 400 and found < 0.1 * true


def test_forest():
    draw = np.random.default_rng(10)
    pairs = draw.integers(0, 400, size=(300, 2)) * 7 - 100
    edges = graphs._forest(pairs)
    nodes = set(pairs.ravel().tolist())
    assert len(edges) < len(nodes)
    assert union(nodes, edges.tolist()) == union(nodes, pairs.tolist())
    assert len(graphs._forest(np.empty((0, 2), np.int64))) == 0


def test_vectors_query_against_all_pairs(spark, tmp_path):
    """The query over a whole table, to which copies at a cosine around 0.9 are added."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    own = np.array([r["embedding"] for r in rows], float)
    draw = np.random.default_rng(11)
    noise = draw.normal(size=own[:600].shape)
    noise *= (np.linalg.norm(own[:600], axis=1) / np.linalg.norm(noise, axis=1))[:, None]
    added = own[:600] + noise * np.linspace(0.05, 0.6, 600)[:, None]
    all_rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in rows] + [(10**6 + i, [float(x) for x in v]) for i, v in enumerate(added)]
    table(spark, all_rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in queries.QUERIES["op8_embedding_near_dedup"](spark, str(tmp_path)).collect()}
    unit = np.array([v for _, v in all_rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = [a for a, _ in all_rows]
    linked = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.9)) if i < j]
    degree = Counter(x for pair in linked for x in pair)
    want = union(set(ids), linked)
    assert len(got) == len(ids) and len(linked) > 400
    assert sum(got[a]["n_links"] == degree[a] for a in ids) >= 0.99 * len(ids)
    assert all(got[a]["n_links"] <= degree[a] for a in ids)
    assert sum(got[a]["component_id"] == want[a] for a in ids) >= 0.99 * len(ids)
    assert sum(got[a]["n_links"] for a in ids) >= 0.98 * sum(degree.values())
    assert got[ids[0]]["audit_recall"] >= 0.99
