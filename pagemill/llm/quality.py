"""Quality classifier: overlapping heuristic labellers, their accuracies by EM, and a hashed linear scorer.

Each labeller votes good (1), bad (0) or abstains (2). The corpus is reduced to counts of vote patterns, of which there
are 3^11 at most, and expectation-maximisation runs on these counts: it estimates for each labeller how often it
votes what on good and on bad documents, and from that the probability that a pattern belongs to a good
one. These posterior labels of a bounded sample train a logistic regression on hashed byte 4-grams, which scores
every document by its whole text.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The bounded sample that trains the scorer: rows with the smallest hashes, of up to so many characters.
SAMPLE_ROWS, SAMPLE_CHARS = 4_000, 20_000
#: Buckets of the hashed features; training steps and their size; weight decay.
BUCKETS_LOG2, STEPS, RATE, DECAY = 13, 120, 0.3, 1e-4
_ABSTAIN = 2


def _vote(value: Column, good: tuple[float, float], bad: tuple[float, float]) -> Column:
    """1 where value is within `good`, 0 where it is outside `bad`, else 2."""
    return (F.when(value.between(*good), 1).when((value < bad[0]) | (value > bad[1]), 0).otherwise(_ABSTAIN))


def _without(text: Column, characters: str) -> Column:
    """text without these; for a few characters faster than translate."""
    return reduce(lambda left, c: F.replace(left, F.lit(c), F.lit("")), characters, text)


def labellers(text: Column, words: Column) -> dict[str, Column]:
    """Name to vote. words: the text's words."""
    n, chars = F.size(words), F.length(text)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    symbols = chars - F.length(F.regexp_replace(text, r"[#$%&*|<>{}\[\]=^~_\\]+", ""))
    marks = chars - F.length(_without(text, ".!?"))
    shouts = chars - F.length(_without(text, "!"))
    runs = F.regexp_count(text, F.lit(r"[#$%&*=_~|^]{3,}|\s[|*#]\s"))
    shouted = F.regexp_count(text, F.lit(r"\b\p{Lu}{2,}\b"))
    echoes = F.regexp_count(text, F.lit(r"(?<!\S)(\S+)\s\1(?!\S)"))
    distinct = F.size(F.array_distinct(words))
    inf = float("inf")
    return {
        "length": F.when(n >= 15, 1).when(n < 2, 0).otherwise(_ABSTAIN),
        "symbols": _vote(symbols / F.greatest(n, F.lit(1)), (0, 0.03), (0, 0.15)),
        "letters": _vote(letters / F.greatest(chars, F.lit(1)), (0.74, 1), (0.68, 1)),
        "runs": _vote(runs / F.greatest(n, F.lit(1)), (0, 0.01), (0, 0.1)),
        "capitals": _vote(capitals / F.greatest(letters, F.lit(1)), (0, 0.2), (0, 0.45)),
        "shouted": _vote(shouted / F.greatest(n, F.lit(1)), (0, 0.05), (0, 0.3)),
        "shouts": _vote(shouts / F.greatest(n, F.lit(1)), (0, 0.02), (0, 0.1)),
        "sentences": _vote(marks / F.greatest(n, F.lit(1)), (0.02, 0.4), (0.005, 0.7)),
        "variety": F.when(n < 12, _ABSTAIN).otherwise(_vote(distinct / F.least(n, F.lit(200)), (0.35, inf), (0.2, inf))),
        "echoes": _vote(echoes / F.greatest(n, F.lit(1)), (0, 0.05), (0, 0.15)),
        "word_length": _vote(chars / F.greatest(n, F.lit(1)), (3.5, 11), (2.5, 16)),
    }


def voted(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """docs with `pattern`, the votes as one number in base 3, and the labellers' names. Null counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(F.col("_text"), r"\s+"), lambda w: w != "")
    # A generator of one row keeps the words from being split anew for each labeller.
    parts = docs.withColumn("_text", whole).withColumn("_words", F.explode(F.array(words)))
    votes = labellers(F.col("_text"), F.col("_words"))
    pattern = sum((v * 3**i for i, v in enumerate(votes.values())), F.lit(0))
    return parts.withColumn("pattern", pattern.cast("int")).drop("_text", "_words"), list(votes)


@dataclass
class Labels:
    """What EM found. votes[c][i][v]: share of vote v of labeller i on documents of class c (1: good)."""

    names: list[str]
    prior: float
    votes: np.ndarray
    posterior: dict[int, float]

    def accuracies(self) -> dict[str, float]:
        """Of each labeller's votes other than abstentions, weighted by the classes' shares."""
        share = np.array([1 - self.prior, self.prior])
        right = sum(share[c] * self.votes[c, :, c] for c in (0, 1))
        cast = sum(share[c] * self.votes[c, :, :2].sum(1) for c in (0, 1))
        return dict(zip(self.names, (right / np.maximum(cast, 1e-12)).tolist()))


def expectation_maximisation(counts: dict[int, int], names: list[str], steps: int = 200) -> Labels:
    """Starts from majority votes; smooths every share by one count, so that a labeller that never votes does no harm."""
    patterns = np.array(sorted(counts), np.int64)
    weight = np.array([counts[p] for p in patterns.tolist()], float)
    votes = patterns[:, None] // 3 ** np.arange(len(names)) % 3
    good, bad = (votes == 1).sum(1), (votes == 0).sum(1)
    # Heuristics find different faults and most documents have none: at the start one vote against outweighs the others.
    p = np.where(bad > 0, 0.5 ** (1 + bad), good / (good + 1.0) if len(good) else good)
    shown = np.eye(3)[votes]
    for _ in range(steps):
        by_class = np.stack([(1 - p) * weight, p * weight])
        table = np.einsum("cp,piv->civ", by_class, shown) + 1
        table /= table.sum(2, keepdims=True)
        prior = (by_class[1].sum() + 1) / (weight.sum() + 2)
        score = np.einsum("piv,civ->cp", shown, np.log(table)) + np.log([[1 - prior], [prior]])
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        moved = np.abs(new - p).max() if len(p) else 0
        p = new
        if moved < 1e-9:
            break
    return Labels(names, float(prior), table, dict(zip(patterns.tolist(), p.tolist())))


def features(text: bytes) -> np.ndarray:
    """Hashed byte 4-grams on a log scale, of length one; all zero for texts under 4 bytes."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(data) < 4:
        return np.zeros(1 << BUCKETS_LOG2, np.float32)
    grams = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    slots = (grams * np.uint32(2654435769)) >> np.uint32(32 - BUCKETS_LOG2)
    x = np.log1p(np.bincount(slots, minlength=1 << BUCKETS_LOG2)).astype(np.float32)
    return x / np.linalg.norm(x)


def train(texts: list[bytes], target: np.ndarray) -> np.ndarray:
    """Logistic regression on posterior labels by gradient steps with momentum; the last weight is the bias."""
    w = np.zeros((1 << BUCKETS_LOG2) + 1)
    if not texts:
        return w
    x = np.empty((len(texts), 1 << BUCKETS_LOG2), np.float32)
    for row, text in zip(x, texts):
        row[:] = features(text)
    speed = np.zeros_like(w)
    for _ in range(STEPS):
        miss = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -30, 30))) - target
        slope = np.append(x.T @ miss.astype(np.float32), miss.sum()) / len(texts) + DECAY * w
        speed = 0.9 * speed - RATE * slope * np.append(np.full(len(w) - 1, 100.0), 1.0)
        w += speed
    return w


def fit(docs: DataFrame) -> tuple[Labels, np.ndarray]:
    """Labels from all of docs (doc_id, text); the scorer's weights from the bounded sample."""
    own = docs.select("doc_id", "text")
    patterns, names = voted(own)
    # At most 3^11 rows.
    counts = {r["pattern"]: r["count"] for r in patterns.groupBy("pattern").count().collect()}
    labels = expectation_maximisation(counts, names)
    rank = F.xxhash64("doc_id", F.length("text"))
    some = (docs.where(F.length("text").between(1, SAMPLE_CHARS)).select("doc_id", rank.alias("rank"))
            .orderBy("rank", "doc_id").limit(SAMPLE_ROWS))
    # Votes are taken of the chosen texts alone.
    chosen = (own.where(F.length("text").between(1, SAMPLE_CHARS))
              .join(F.broadcast(some.select("doc_id").distinct()), "doc_id")
              .groupBy("doc_id").agg(F.min("text").alias("text")))
    rows = voted(chosen)[0].orderBy("doc_id").limit(SAMPLE_ROWS).select("text", "pattern").collect()
    target = np.array([labels.posterior[r["pattern"]] for r in rows])
    return labels, train([r["text"].encode() for r in rows], target)


def scored(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """docs with `score`, 0 to 1."""
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary())
            raw = np.array([features(t.as_py() or b"") @ weights[:-1] + weights[-1] for t in texts], float)
            scores = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, weak_label, score, kept: one row per row of docs.

    weak_label is the posterior probability, from the votes alone, that the document is good; score is the linear
    scorer's; kept says whether score is 0.5 or more. Null and empty texts count as empty: their
    weak label is that of their votes and their score that of the bias alone. Rows with a null doc_id and repeated rows
    are scored like others. Other columns play no part. An empty table gives an empty table.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    labels, weights = fit(own)
    patterns, _ = voted(own)
    table = own.sparkSession.createDataFrame(list(labels.posterior.items()) or [(0, 0.5)], "pattern int, weak_label double")
    out = scored(patterns, weights).drop("text").join(F.broadcast(table), "pattern", "left")
    return out.select("doc_id", "weak_label", "score", (F.col("score") >= 0.5).alias("kept"))
