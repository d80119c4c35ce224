"""Cross-entropy difference: a target and a background bigram model over one vocabulary score each document.

The vocabulary is all words of all documents, however rare and however long. Both models are bigrams interpolated with
unigrams and a uniform share, with the same weights and vocabulary. A token's loss difference is the background model's
log-probability minus the target model's; a document's score is the mean over its tokens, so lower means nearer to the
target.

The counts are never in one place. Documents are dealt to chunks; a chunk counts its pairs, first tokens and second
tokens by hashed keys and deals the different ones to buckets of the key range. A bucket adds up each key over all chunks
and gives every chunk the sums of its own keys, in its own order, with which the chunk scores its documents. A key has one
entry per chunk at most, so a common pair is not a hot key. With its sums each bucket gives every chunk its numbers of different
words and of tokens, so the totals are known where they are needed. The texts are shuffled once, to their chunks: counting and
scoring read that same exchange, and nothing else is written. The driver gets the number of characters alone.
"""

import math
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The uniform share is spread over all different tokens, and over so many at least. An explicit size is this at most.
VOCABULARY = 2_048
#: Shares of the bigram and unigram estimates; the rest is uniform.
BIGRAM, UNIGRAM = 0.7, 0.25
#: Longer words never enter a vocabulary of an explicit size.
WORD_CHARS = 64
#: Characters of a chunk, characters per bucket, least number of buckets. So many neighbouring rows go to one chunk.
CHUNK_CHARS, BUCKET_CHARS, LEAST_BUCKETS, NEIGHBOURS = 3 << 20, 1 << 24, 64, 16
#: Ids of target documents are broadcast up to this number; more of them are joined by a shuffle.
BROADCAST_IDS = 2_000_000
_PAIR, _AFTER, _ONE = range(3)
_START = xxhash.xxh64_intdigest(b"")  # no word is empty
_COUNTS = ("counts", "target_counts", "ends", "target_ends")


def words(text: str) -> list[str]:
    return text.split()


def vocabulary(docs: DataFrame, size: int) -> list[str]:
    """The size - 1 most frequent words of the column text, ties by the word."""
    word = F.explode(F.split(F.coalesce("text", F.lit("")), r"(?U)\s+")).alias("word")
    rows = (docs.select(word).where(F.length("word").between(1, WORD_CHARS)).groupBy("word").count()
            .orderBy(F.desc("count"), "word").limit(size - 1).collect())
    return [r["word"] for r in rows]


def _key(kind: int, second: np.ndarray, first: np.ndarray | int = 0) -> np.ndarray:
    """62 bits of a hash of the hashed words, and the kind in the lowest two bits."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second + np.array([kind + 1], np.uint64) * np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & ~np.uint64(3) | np.uint64(kind)


class Tally:
    """Sorted keys of a chunk: of its pairs, its words and the start, with their counts in all documents and in target documents.
    ends: how often a word is a document's last one, so that its count as a first token of a pair is the
    difference and needs no key of its own. sizes: tokens of each document. known: the words of an explicit vocabulary, others
    are the token that also stands before the first."""

    def __init__(self, texts: list[str | None], targets: list[bool | None], known: set[str] | None = None):
        split = [words(t or "") for t in texts]
        self.sizes = np.fromiter(map(len, split), np.int64, len(split))
        encoded = pa.array([w for own in split for w in own], pa.large_string()).dictionary_encode()
        different = encoded.dictionary.to_pylist()
        hashes = np.array([_START, *(_START if known is not None and w not in known else xxhash.xxh64_intdigest(w.encode()) for w in different)], np.uint64)
        second = encoded.indices.to_numpy().astype(np.int64) + 1
        first = np.concatenate(([0], second[:-1]))[:len(second)]
        full = self.sizes > 0
        begins = (np.cumsum(self.sizes) - self.sizes)[full]
        first[begins] = 0
        last = second[np.cumsum(self.sizes)[full] - 1]
        named = np.array([bool(t) for t in targets], bool)
        target = np.repeat(named, self.sizes)

        pairs, at_pair = np.unique(_key(_PAIR, hashes[second], hashes[first]), return_inverse=True)
        ones, at_word = np.unique(_key(_ONE, hashes), return_inverse=True)  # the start, of which no text is a token, among them
        keys = np.concatenate((pairs, ones, _key(_AFTER, np.array([_START], np.uint64))))
        zero = np.zeros(len(pairs), np.int64)
        self.counts, self.ends = (np.stack([np.concatenate(x) for x in both]) for both in (
            [(np.bincount(at_pair[t], minlength=len(pairs)), np.bincount(at_word[second[t]], minlength=len(ones)), [n])
             for t, n in ((slice(None), full.sum()), (target, (full & named).sum()))],
            [(zero, np.bincount(at_word[x], minlength=len(ones)), [0]) for x in (last, last[named[full]])]))
        order = np.argsort(keys)
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.keys, self.counts, self.ends = keys[order], self.counts[:, order], self.ends[:, order]
        self.pair, word = place[at_pair], place[len(pairs) + at_word]
        self.first, self.second, self.start = word[first], word[second], place[-1]
        self.begins = hashes[first] == _START

    def of_tokens(self, counts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of each token's pair, of its first token as such, and of the token, from those of the keys."""
        after = counts[self.first] - ends[self.first] + np.where(self.begins, counts[self.start], 0)
        return counts[self.pair], after, counts[self.second]


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest takes, all lowest bytes first: high bytes are mostly zero and compress."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _steps(keys: np.ndarray) -> bytes:
    """Ascending keys: the first one, then the steps to the next."""
    return keys[:1].tobytes() + _packed(np.diff(keys))


def _keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate((np.frombuffer(data[:8], np.uint64), _unpacked(data[8:]))), dtype=np.uint64) if len(data) > 1 else np.zeros(0, np.uint64)


def _dealt(rows: pa.Table, buckets: int, known: set[str] | None) -> pa.Table:
    """chunk, bucket, keys and their counts: what a chunk has in each bucket of the key range, often nothing."""
    tally = Tally(rows["text"].to_pylist(), rows["target"].to_pylist(), known)
    bucket = (tally.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    return pa.table({
        "chunk": pa.array([rows["chunk"][0].as_py()] * buckets, pa.int64()), "bucket": pa.array(range(buckets), pa.int32()),
        "keys": pa.array([_steps(tally.keys[a:b]) for a, b in parts], pa.binary()),
        **{name: pa.array([_packed(own[a:b]) for a, b in parts], pa.binary())
           for name, own in zip(_COUNTS, (*tally.counts, *tally.ends))}})


def _added(rows: pa.Table) -> pa.Table:
    """chunk, bucket, sums of its keys over all chunks, and the bucket's different words and tokens."""
    keys = [_keys(x) for x in rows["keys"].to_pylist()]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros((len(_COUNTS), len(every)), np.int64)
    for own, name in zip(sums, _COUNTS):
        np.add.at(own, at, np.concatenate([_unpacked(x) for x in rows[name].to_pylist()]).astype(np.int64))
    one = every & np.uint64(3) == _ONE
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({
        "chunk": rows["chunk"], "bucket": rows["bucket"],
        **{name: pa.array([_packed(own[at[e - len(k):e]]) for k, e in zip(keys, ends)], pa.binary()) for name, own in zip(_COUNTS, sums)},
        **{name: pa.array([int(x)] * len(keys), pa.int64())
           for name, x in zip(("words", "background", "target"), ((sums[0, one] > 0).sum(), *sums[:2, one].sum(axis=1)))}})


def _log_share(pair: np.ndarray, after: np.ndarray, one: np.ndarray, total: int, size: int) -> np.ndarray:
    """Log-probability of tokens, by the counts of their pairs, first tokens and second tokens."""
    base = UNIGRAM * one / max(total, 1) + (1 - UNIGRAM - BIGRAM) / size
    rest = np.where(after > 0, 1.0, 1 / (1 - BIGRAM))  # a first token never seen leaves all to the others
    return np.log(base * rest + BIGRAM * np.divide(pair, after, out=np.zeros(len(pair)), where=after > 0))


def score(docs: DataFrame, targets: DataFrame, size: int | None = None) -> DataFrame:
    """doc_id, n_tokens, loss_difference: one row per row of docs (doc_id, text).

    targets: doc_id of the target documents, part of docs. size: tokens of a smaller vocabulary, that of the most frequent
    words, all other words one token; without it all words are in the vocabulary. Words stand between white space. Null,
    empty and blank texts have no tokens and a null score. Rows with a null doc_id count for the background and are scored.
    Repeated rows count and are scored each. Without targets the target model is uniform. An empty table gives an empty table.
    docs must give its rows in the same order when a lost task reads them again, as a table does.
    """
    own = docs.select("doc_id", "text")
    if size is not None and not 1 < size <= VOCABULARY:
        raise ValueError(f"an explicit vocabulary has 2 to {VOCABULARY} tokens")
    known = None if size is None else set(vocabulary(own, size))
    wanted = targets.select("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(True))
    if wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks, buckets = max(1, math.ceil(chars / CHUNK_CHARS)), max(LEAST_BUCKETS, math.ceil(chars / BUCKET_CHARS))
    # By the place in the input and not by value: rows that are often repeated spread over the chunks.
    place = F.floor(F.monotonically_increasing_id() / NEIGHBOURS)
    dealt = own.withColumn("chunk", F.pmod(F.xxhash64(place), F.lit(chunks))).join(wanted, "doc_id", "left")
    by_chunk = dealt.select("chunk", "doc_id", "target", "text").groupBy("chunk")
    packed = ", ".join(f"{name} binary" for name in _COUNTS)
    sums = by_chunk.applyInArrow(
        lambda rows: _dealt(rows, buckets, known), f"chunk long, bucket int, keys binary, {packed}"
    ).groupBy("bucket").applyInArrow(
        lambda rows: _added(rows), f"chunk long, bucket int, {packed}, words long, background long, target long")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("bucket")
        counts, target_counts, ends, target_ends = (
            np.concatenate([_unpacked(x) for x in right[name].to_pylist()]).astype(np.int64) for name in _COUNTS)
        different, *totals = (sum(right[name].to_pylist()) for name in ("words", "background", "target"))
        tokens = max(VOCABULARY, different + 1)  # one more for what stands before the first word
        tally = Tally(left["text"].to_pylist(), left["target"].to_pylist(), known)
        background, target = (_log_share(*tally.of_tokens(c, e), n, tokens)
                              for c, e, n in zip((counts, target_counts), (ends, target_ends), totals))
        number = np.repeat(np.arange(len(tally.sizes)), tally.sizes)
        means = np.bincount(number, background - target, len(tally.sizes)) / np.maximum(tally.sizes, 1)
        return pa.table({"doc_id": left["doc_id"], "n_tokens": pa.array(tally.sizes),
                         "loss_difference": pa.array(means, mask=tally.sizes == 0)})

    schema = T.StructType([own.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("loss_difference", T.DoubleType())])
    return by_chunk.cogroup(sums.groupBy("chunk")).applyInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents against those labelled to be of good quality."""
    return score(docs, labels.where("quality = 1"))
