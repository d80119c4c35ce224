"""Finding short texts inside long ones by MinHash over windows, built from DataFrame functions only.

Two ways to retrieve candidates, by what the caller's short texts are like; both verify with `verified`.

`by_size` partitions short texts by their number T of shingles: L/2 < T <= L for L = 8, 16, 32 ... Windows of
a document are 2L shingles long and begin at every L-th, so a passage of up to L + 1 shingles lies whole in
one of them. A passage with share c of the short text then has Jaccard similarity of c/4 or more with its
window, and b bands of one row meet with probability 1 - (1 - c/4)^b or more: 0.998 for c = 0.8 and 0.9997
for c = 1 with 28 bands at the lower end of a class, and more above it. Texts with T <= 4 go the other way.

`by_small_windows` cuts both sides into windows of min(T, 4) shingles that begin at every shingle, with the least
hash of each window as its band. A run of that many shingles that both sides share always meets. With c
= 0.8, a text of T <= 4 is matched by all its shingles only, and in a longer one each changed word takes at
most five shingles, so that a run of four is left: collision is certain, not only likely.

Each document's windows are made where the document lies: rows are dealt out by document once, before they
are taken apart, and no later grouping moves them again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.shared import materialized, written

SHINGLE_WORDS, CONTAINMENT, BANDS = 5, 0.8, 28
#: A short side of up to so many rows is broadcast (bands, at most 50 MB); a larger one is joined by shuffling.
BROADCAST_ROWS = 50_000
_SMALL = 4
_KEYS = ["doc_id", "version"]


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits. Null: none."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def shingle_texts(words: Column, size: int = SHINGLE_WORDS) -> Column:
    """All runs of `size` words; fewer words are one shingle; none give none."""
    last = F.greatest(F.size(words) - size + 1, F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, size), " "))
    return F.when(F.size(words) > 0, runs).otherwise(F.array().cast("array<string>"))


def _hashes(docs: DataFrame, keys: list[str], text: str, size: int) -> DataFrame:
    """keys and `h`, the hash of each shingle in order; documents without words are left out."""
    worded = materialized(docs, normal_words(F.col(text)), "w", *keys).where(F.size("w") > 0)
    hashed = materialized(worded, F.transform("w", lambda w: F.xxhash64(w)), "v", *keys)
    shingles = F.when(
        F.size("v") >= size,
        F.transform(F.sequence(F.lit(0), F.size("v") - size),
                    lambda i: F.xxhash64(*[F.get("v", i + k) for k in range(size)]))
    ).otherwise(F.array(F.xxhash64(F.col("v"))))
    return materialized(hashed, shingles, "h", *keys)


def _band(values: list[Column]) -> Column:
    """One row per band: number and value."""
    return F.explode(F.array(*[F.struct(F.lit(i).alias("band"), v.alias("value")) for i, v in enumerate(values)]))


def _mins(h: Column, bands: int) -> list[Column]:
    return [F.min(F.xxhash64(h, F.lit(i))).alias(f"m{i}") for i in range(bands)]


def _places(levels: list[int], step: int) -> Column:
    """The windows of each level that hold a chunk of `step` shingles: the one that begins with it or before it,
    and the one before that."""
    return F.explode(F.array(*[
        F.struct(F.lit(n).alias("level"), (F.floor(F.col("chunk") / (n // step)) - back).cast("int").alias("window"))
        for n in levels for back in (0, 1)])).alias("p")


def _large_bands(hashed: DataFrame, keys: list[str], levels: list[int], bands: int) -> DataFrame:
    """keys, level, band, value of every window of the levels (powers of two, ascending)."""
    names = [f"m{i}" for i in range(bands)]
    chunks = (hashed.select(*keys, F.posexplode("h").alias("at", "h"))
              .groupBy(*keys, F.floor(F.col("at") / levels[0]).cast("int").alias("chunk")).agg(*_mins(F.col("h"), bands)))
    windows = (chunks.select(*keys, *names, _places(levels, levels[0]))
               .groupBy(*keys, "p").agg(*[F.min(m).alias(m) for m in names]))
    return (windows.select(*keys, F.col("p.level").alias("level"), _band([F.col(m) for m in names]).alias("b"))
            .select(*keys, "level", "b.*"))


def _runs(size: int) -> Column:
    """Level `size` and the least hash of each run of `size` shingles of the array h."""
    def run(i):
        values = [F.get("h", i + k) for k in range(size)]
        return F.struct(F.lit(size).alias("level"), (F.least(*values) if size > 1 else values[0]).alias("value"))

    return F.when(F.size("h") >= size, F.transform(F.sequence(F.lit(0), F.size("h") - size), run)
                  ).otherwise(F.array().cast("array<struct<level:int,value:bigint>>"))


def _small_bands(hashed: DataFrame, keys: list[str], levels: list[int]) -> DataFrame:
    """keys, level, value of every window of the levels (1 to 4). They go straight into the join: nothing is shuffled."""
    return hashed.select(*keys, F.explode(F.concat(*[_runs(n) for n in levels])).alias("b")).select(*keys, "b.*")


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text, and version: documents are told apart by doc_id and text."""
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
            .withColumn("version", F.xxhash64("text")))


def _items(items: DataFrame, item: str, text: str) -> DataFrame:
    return items.select(F.col(item).alias("item"), F.col(text).alias("item_text")).where("item is not null")


def _retrieved(large: DataFrame, short: DataFrame, on: list[str], asked: DataFrame) -> DataFrame:
    few = asked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return large.join(F.broadcast(short) if few else short, on).select(*_KEYS, "item").distinct()


def by_small_windows(own: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """Candidates doc_id, version, item."""
    hashed = _hashes(asked, ["item"], "item_text", size).withColumn("t", F.least(F.size(F.array_distinct("h")), F.lit(_SMALL)))
    short = _small_bands(hashed, ["item", "t"], list(range(1, _SMALL + 1))).where("level = t").drop("t").distinct()
    levels = sorted(r["level"] for r in short.select("level").distinct().collect())  # 1 to 4
    if not levels:
        return own.join(asked.select("item", "item_text"), F.col("text") == F.col("item_text")).where("false").select(*_KEYS, "item")
    large = _small_bands(_hashes(own, _KEYS, "text", size), _KEYS, levels)
    return _retrieved(large, short, ["level", "value"], asked)


def by_size(own: DataFrame, asked: DataFrame, size: int, bands: int) -> DataFrame:
    """Candidates doc_id, version, item."""
    each = _hashes(asked, ["item"], "item_text", size).select("item", F.array_distinct("h").alias("h"))
    power = F.pow(F.lit(2), F.ceil(F.log2(F.size("h"))))
    leveled = each.withColumn("level", F.when(F.size("h") <= _SMALL, 0).otherwise(F.greatest(F.lit(8), power)).cast("int"))
    # At most one level per power of two: a handful of numbers.
    levels = sorted(r["level"] for r in leveled.select("level").distinct().collect())
    small = asked.join(leveled.where("level = 0").select("item"), "item", "left_semi")
    if levels in ([], [0]):
        return by_small_windows(own, small, size)
    names = [f"m{i}" for i in range(bands)]
    short = (leveled.where("level > 0").select("item", "level", F.explode("h").alias("h")).groupBy("item", "level")
             .agg(*_mins(F.col("h"), bands))
             .select("item", "level", _band([F.col(m) for m in names]).alias("b")).select("item", "level", "b.*"))
    large = _large_bands(_hashes(own.repartition(*_KEYS), _KEYS, "text", size), _KEYS, [n for n in levels if n], bands)
    found = _retrieved(large, short, ["level", "band", "value"], asked)
    return found.union(by_small_windows(own, small, size)) if 0 in levels else found


def verified(found: DataFrame, own: DataFrame, asked: DataFrame, size: int, containment: float) -> DataFrame:
    """doc_id, item, n_found, n_item, containment of the candidates that hold enough of the item's shingles,
    compared as text over the whole document."""
    found = written(found, "candidates")  # read twice below
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["version"] == b["version"])
    some = found.select(*_KEYS).distinct()
    again = own.alias("o").join(some.alias("s"), same(_Names("o"), _Names("s")), "left_semi")
    held = (materialized(again, normal_words(F.col("text")), "w", *_KEYS)
            .select(*_KEYS, F.explode(F.array_distinct(shingle_texts(F.col("w"), size))).alias("shingle")))
    wanted = (materialized(asked, normal_words(F.col("item_text")), "w", "item")
              .select("item", F.array_distinct(shingle_texts(F.col("w"), size)).alias("s"))
              .select("item", F.size("s").alias("n_item"), F.explode("s").alias("shingle")))
    pairs = found.join(wanted, "item")
    hits = (pairs.alias("p").join(held.alias("h"), same(_Names("p"), _Names("h")) & (F.col("p.shingle") == F.col("h.shingle")), "left_semi")
            .groupBy("doc_id", "version", "item", "n_item").agg(F.countDistinct("shingle").alias("n_found")))
    return (hits.where(F.col("n_found") >= F.col("n_item") * F.lit(containment))
            .groupBy("doc_id", "item", "n_item").agg(F.max("n_found").alias("n_found"))
            .select("doc_id", "item", "n_found", "n_item", (F.col("n_found") / F.col("n_item")).alias("containment")))


def contained(docs: DataFrame, items: DataFrame, doc_id: str, item: str, text: str = "text", item_text: str = "text",
              size: int = SHINGLE_WORDS, containment: float = CONTAINMENT, bands: int | None = BANDS) -> DataFrame:
    """doc_id, item, n_found, n_item, containment for each document that holds the share `containment` or more
    of the different shingles of an item. bands: of by_size; None: by_small_windows.

    Words are lower-case runs of letters and digits. Null and empty texts hold nothing and are held by nothing.
    Rows with a null doc_id are compared, and repeated rows give one result row; so do rows that share a doc_id,
    with the highest count of any of them. A text with fewer words than a shingle is one shingle. Items with a
    null name are left out; items that share a name count as one text after the other only if equal. Other columns
    play no part. Without items or documents the result is empty.
    """
    own, asked = _documents(docs, doc_id, text), _items(items, item, item_text)
    found = by_size(own, asked, size, bands) if bands else by_small_windows(own, asked, size)
    return verified(found, own, asked, size, containment)


class _Names:
    """Columns of an aliased table."""

    def __init__(self, alias: str):
        self.alias = alias

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}")
