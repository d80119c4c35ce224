"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.components import connected_components
from pagemill.llm.shared import written

SHINGLE_WORDS, MAX_BITS = 3, 2
#: A fingerprint's 64 bits in 8 blocks. Two that differ in d bits agree in 8 - d blocks at least, so
#: they share a key for one choice of 8 - d blocks. With d = 2 a key fixes 48 bits: random fingerprints
#: of 10^12 documents hardly ever meet, and a key can hold 2^16 different ones at the very most.
BLOCKS = 8
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STEP = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of the shingles of a text: a bit is set where over half the hashes have it."""
    parts = text.translate(_LOWER).split()  # bytes.split() cuts at 09-0D and 20
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    first, last = starts[:n].tolist(), ends[min(words, len(parts)) - 1:].tolist()
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, _STEP):
        hashes = np.array([digest(joined[i:j], 42) for i, j in zip(first[k:k + _STEP], last[k:k + _STEP])], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """docs with `simhash` (bigint, the 64 bits), which replaces a column of that name."""
    docs = docs.drop("simhash")
    schema = T.StructType([*docs.schema.fields, T.StructField("simhash", T.LongType())])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))],
                                             names=[*batch.schema.names, "simhash"])

    return docs.mapInArrow(run, schema)


def _masks(max_bits: int) -> list[int]:
    """Bit masks of all choices of BLOCKS - max_bits blocks, as signed 64-bit numbers."""
    width = 64 // BLOCKS
    masks = [sum(((1 << width) - 1) << width * b for b in kept) for kept in combinations(range(BLOCKS), BLOCKS - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: every pair of different values of `simhash` (a < b) that differ in max_bits bits or fewer."""
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("simhash").bitwiseAND(F.lit(m)).alias("part"))
        for i, m in enumerate(_masks(max_bits))]))
    # Spark sizes the exploded rows as if there were one per fingerprint, so neither side may be broadcast.
    keyed = prints.select("simhash").distinct().select("simhash", keys.alias("k")).select("simhash", "k.*").hint("merge")
    left = keyed.withColumnRenamed("simhash", "a")
    right = keyed.withColumnRenamed("simhash", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (left.join(right, ["choice", "part"]).where((F.col("a") < F.col("b")) & close)
            .select("a", "b").distinct())


def _rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """distinct (a row for each simhash) with `root`, the same for all simhashes of a component."""
    linked = connected_components(links(distinct, max_bits), "a", "b").withColumnRenamed("node", "simhash")
    return distinct.join(linked, "simhash", "left").withColumn("root", F.coalesce("component", "simhash")).drop("component")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, simhash, component_id: one row per row of docs.

    Words are what stands between blanks (09-0D, 20) after A-Z became lower case; a text with fewer
    words than a shingle is one shingle; null, empty and blank texts have fingerprint 0, which links
    like any other. component_id is the smallest doc_id reachable over links, null only if all of them
    are null; rows with a null doc_id and repeated rows are kept and link like others. Other columns of docs
    play no part. An empty table gives an empty table.

    Copies share a fingerprint, so the join runs on different fingerprints only, however large a group
    of copies is; of these, a fingerprint has a bounded number within max_bits.
    """
    prints = written(
        fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", words).drop("text"),
        "fingerprints")
    distinct = prints.groupBy("simhash").agg(F.min("doc_id").alias("first"))
    rooted = _rooted(distinct, max_bits)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("simhash", "root").join(smallest, "root").select("simhash", "component_id")
    return prints.join(named, "simhash").select("doc_id", "simhash", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with the columns of docs: that of the smallest doc_id, of its rows the one whose text, then
    whose other columns have the smallest hash.

    A text without near copies stays, whatever other rows share its doc_id. Rows with a null doc_id are in no component;
    of those with one text one stays. Repeated rows of the one that stays become one row. Columns may bear any names; an empty
    table gives an empty table.
    """
    columns = docs.columns
    doc_id, text = (f"c{columns.index(c)}" for c in ("doc_id", "text"))
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    # A row is known by its doc_id and hashes of its text and of the other columns, so that texts are shuffled once.
    own = own.select("*", F.xxhash64(text).alias("version"), F.xxhash64(F.to_json(F.struct(
        F.lit(0), *[c for c in own.columns if c != text]))).alias("rest"))
    prints = written(fingerprints(own.select(doc_id, "version", "rest", text), text, words).drop(text), "fingerprints")
    rooted = _rooted(prints.select("simhash").distinct(), max_bits)
    row = F.struct(doc_id, "version", "rest")
    named = (prints.where(F.col(doc_id).isNotNull()).join(rooted, "simhash").groupBy("root").agg(F.min(row).alias("r")).select("r.*"))
    unnamed = (prints.where(F.col(doc_id).isNull()).groupBy(doc_id, "version").agg(F.min("rest").alias("rest")))
    keys = [F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.col(doc_id).isNull().alias("unnamed"), "version", "rest"]
    kept = named.unionByName(unnamed).select(*keys)
    same = ["name", "unnamed", "version", "rest"]
    # The join leaves rows where their keys are, so dropping repeated ones moves nothing.
    found = own.select(*keys, *own.columns[:len(columns)]).join(kept, same, "left_semi").dropDuplicates(same)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
