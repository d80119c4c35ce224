"""Toxicity by compression distance: two zstandard dictionaries, window lengths, calibrated thresholds.

A window is one word, without punctuation and in lower case, written three times with a blank before each (so short
a text would not pay for a block's head otherwise). One dictionary is trained on windows that stand in toxic
training documents much more often than in ordinary ones, the other on windows of ordinary documents. A window that
the toxic dictionary compresses to fewer bytes than the ordinary one speaks for toxicity; by how many bytes,
and how near the length is to the shortest that the toxic dictionary reaches, decides how much. These thresholds
get their weights on training documents that took no part in the dictionaries.

The dictionaries are trained by document frequency and loaded as raw content. The library's own trainer picks
segments by a heuristic that left frequent words out: on the same sample it found from 2 to 99 % of the
held-out toxic English documents, depending on the order of its input.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The bounded sample that is fitted: labelled rows of each class, the smallest by a hash, of up to so many characters.
TOXIC_ROWS, ORDINARY_ROWS, SAMPLE_CHARS = 2_000, 8_000, 20_000
#: Every third sampled document calibrates, the others train the dictionaries.
CALIBRATES = 3
#: A window trains the toxic dictionary if it is in this share of toxic documents and so many times rarer elsewhere.
LEAST_SHARE, LEAST_ROWS, RATIO = 0.006, 3, 8
TOXIC_BYTES, ORDINARY_BYTES = 16_384, 112_640
#: Steps of the byte difference, and of the distance from the toxic dictionary's shortest window.
DIFFERENCES, DISTANCES = 10, 3
MEMO_ENTRIES = 400_000
_CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\"()", b"abcdefghijklmnopqrstuvwxyz         ")


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    shortest: int
    weights: list[float]
    prior: float


def words(text: str) -> list[bytes]:
    return text.encode().translate(_CLEAN).split()


def _window(word: bytes) -> bytes:
    return (b" " + word) * 3


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=17, chain_log=17, search_log=6, min_match=3, target_length=64,
        strategy=zstandard.STRATEGY_BTULTRA, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=parameters)


def _train(counts: dict[bytes, int], size: int) -> bytes:
    """A dictionary of the most frequent windows, the most frequent last, where references to them are shortest."""
    return b"".join(map(_window, sorted(counts, key=lambda w: (counts[w], w))))[-size:]


class Windows(dict):
    """Code of each window seen: difference and distance steps. Two generations bound the memory."""

    def __init__(self, toxic: bytes, ordinary: bytes, shortest: int = 0):
        super().__init__()
        self.toxic, self.ordinary, self.shortest, self.old = _compressor(toxic), _compressor(ordinary), shortest, {}

    def __missing__(self, word: bytes) -> int:
        code = self.old.get(word)
        if code is None:
            window = _window(word)
            length = len(self.toxic.compress(window))
            gain = min(max(len(self.ordinary.compress(window)) - length, 0), DIFFERENCES - 1)
            code = min(max(length - self.shortest, 0), DISTANCES - 1) * DIFFERENCES + gain
        if len(word) <= 64:
            if len(self) >= MEMO_ENTRIES // 2:
                self.old = dict(self)
                self.clear()
            self[word] = code
        return code

    def features(self, text: str | None) -> np.ndarray:
        """For each distance and difference: how many windows reach it, on a log scale; and a one for the bias."""
        codes = list(map(self.__getitem__, words(text or "")))
        counts = np.bincount(codes, minlength=DISTANCES * DIFFERENCES).reshape(DISTANCES, DIFFERENCES) if codes else np.zeros((DISTANCES, DIFFERENCES))
        reached = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
        return np.concatenate((np.log1p(reached[:, 1:]).ravel(), [np.log1p(len(codes)), 1.0]))


def _different(texts: list[str]) -> list[str]:
    """Leaves out near copies of texts before, whose rare words would pass for typical ones."""
    seen, kept = set(), []
    for text in texts:
        own = words(text)
        least = sorted({zlib.crc32(b" ".join(own[i:i + 4])) for i in range(max(1, len(own) - 3))})[:10]
        if sum(x in seen for x in least) < 4:
            kept.append(text)
        seen.update(least)
    return kept


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the bias."""
    w, ridge = np.zeros(x.shape[1]), np.append(np.ones(x.shape[1] - 1), 1e-6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_texts(toxic: list[str], ordinary: list[str]) -> Model:
    toxic, ordinary = _different(toxic), _different(ordinary)
    own = [t for i, t in enumerate(toxic) if i % CALIBRATES], [t for i, t in enumerate(ordinary) if i % CALIBRATES]
    counts = [Counter(w for t in texts for w in set(words(t))) for texts in own]
    n, m = len(own[0]), max(1, len(own[1]))
    least = max(LEAST_ROWS, round(LEAST_SHARE * n))
    typical = {w: c for w, c in counts[0].items() if c >= least and c / n >= RATIO * (counts[1][w] + 0.5) / m}
    usual = {w: c for w, c in counts[1].items() if c > 1 and w not in typical}
    prior = min(0.49, (len(toxic) + 1) / (len(toxic) + len(ordinary) + 2))
    if not typical or not usual:
        return Model(b"", b"", 0, [], prior)
    trained = _train(typical, TOXIC_BYTES), _train(usual, ORDINARY_BYTES)
    compress = _compressor(trained[0]).compress
    shortest = int(np.quantile([len(compress(_window(w))) for w in typical], 0.02))
    windows = Windows(*trained, shortest)
    held = [t for i, t in enumerate(toxic) if not i % CALIBRATES], [t for i, t in enumerate(ordinary) if not i % CALIBRATES]
    x = np.array([windows.features(t) for texts in held for t in texts])
    y = np.repeat([1.0, 0.0], [len(held[0]), len(held[1])])
    return Model(*trained, shortest, _logistic(x, y).tolist(), prior)


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the doc_id's text is divisible by 5; a null doc_id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labels (doc_id, toxic 0/1) of documents that are not held out.

    Rows with a null doc_id, label or text are left out; of several labels of a document, 1 prevails. The sample is bounded
    by TOXIC_ROWS and ORDINARY_ROWS times SAMPLE_CHARS: it is what comes to the driver. Where no window is
    typical of toxic documents (few or no labels), every text gets the share of toxic rows, below 0.5, as its score.
    """
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    usable = docs.where(F.length("text").between(1, SAMPLE_CHARS)).select("doc_id")
    rank = F.xxhash64("doc_id", F.lit("sample"))
    chosen = known.join(usable, "doc_id", "left_semi")
    ids = chosen.where("toxic = 1").orderBy(rank, "doc_id").limit(TOXIC_ROWS).union(
        chosen.where("toxic = 0").orderBy(rank, "doc_id").limit(ORDINARY_ROWS))
    rows = (docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS)).join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
            .orderBy(rank, "doc_id").select("toxic", "text").collect())
    return fit_texts([r["text"] for r in rows if r["toxic"] == 1], [r["text"] for r in rows if r["toxic"] == 0])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with `score` (0 to 1), which replaces a column of that name. Whole texts; null counts as empty; rows,
    repeated ones too, and other columns pass through; an empty table gives an empty table."""
    docs = docs.drop("score")
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.array(model.weights)
        windows = Windows(model.toxic, model.ordinary, model.shortest) if len(weights) else None
        for batch in batches:
            if windows is None:
                scores = np.full(batch.num_rows, model.prior)
            else:
                scores = np.array([windows.features(t.as_py()) @ weights for t in batch.column(place)], float)
                scores = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    own = docs.select("doc_id", "text")
    return score(own, fit(own, labels)).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def ordinary_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, with their columns."""
    own = docs.select("doc_id", "text")
    model = fit(own, labels)
    columns = docs.columns
    marked = score(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]), model, f"c{columns.index('text')}")
    return marked.where("score < 0.5").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
