"""Periodic runs of words by block convolution.

At each dyadic scale L the texts are cut into blocks of L words. A run of period q, L <= q < 2 L, that is at least four
periods long holds a whole block together with the copy of it q words further on: a block begins within the run's
first L words, ends by 2 L - 1 <= 2 q - 1, and its copy by 3 q - 1. So each run's period is among the distances, from L
to 2 L - 1, at which some block occurs again in the window that follows it.

Where a block occurs is found by convolution: the sums of squared differences between the block and each stretch of the
window, sum a^2 + sum b^2 - 2 sum a b, in whole numbers by a number-theoretic transform modulo a prime. Word numbers are split
into digits small enough for the sums to stay below the prime, so a sum that is zero means equality. A block whose words
do not all recur within 2 L - 1 words has no such occurrence and needs no transform.

Each distance found seeds an extension: how far the words keep equal at that distance to the left and to the right, by
bisecting over prefix hashes and checked word by word. The stretch is a run if it is long enough and no part of the distance
is a period. All blocks of a scale, of many documents, are one array; documents are set apart by words of their own.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.shared import materialized

#: A run has so many words and so many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: A prime whose units hold roots of unity of the orders 2^1 to 2^23, and a generator of them.
PRIME, GENERATOR, ORDERS = 998_244_353, 3, 23
#: Words of documents treated together (a longer one alone), and values of the blocks transformed together.
CHUNK_WORDS, CHUNK_VALUES = 1 << 17, 1 << 19
#: Primes and bases of the prefix hashes.
_MODULI, _BASES = (2_147_483_647, 2_147_483_629), (1_000_003, 911_382_323)


def _powers(base: int, count: int, prime: int) -> np.ndarray:
    """base^0 to base^(count - 1) modulo prime."""
    out = np.ones(max(count, 1), np.uint64)
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += step
    return out


class Transform:
    """Number-theoretic transforms of the rows of an array, of 2^order values each."""

    def __init__(self, order: int):
        if order > ORDERS:
            raise ValueError(f"no root of unity of order 2^{order}")
        self.order, size = order, 1 << order
        root = pow(GENERATOR, (PRIME - 1) >> order, PRIME)
        half = max(1, size >> 1)
        self.forward_roots = _powers(root, half, PRIME)
        self.inverse_roots = _powers(pow(root, PRIME - 2, PRIME), half, PRIME)
        self.scale = np.uint64(pow(size, PRIME - 2, PRIME))

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """Values in bit-reversed order: sums and differences of halves, from the whole row down."""
        prime, x = np.uint64(PRIME), rows.copy()
        for level in range(self.order):
            part = x.reshape(len(rows), 1 << level, 2, -1)
            a, b = part[:, :, 0], part[:, :, 1]
            difference = (a + (prime - b)) * self.forward_roots[::1 << level] % prime
            a += b
            a -= prime * (a >= prime)
            part[:, :, 1] = difference
        return x

    def inverse(self, rows: np.ndarray) -> np.ndarray:
        """The way back, from bit-reversed order."""
        prime, x = np.uint64(PRIME), rows.copy()
        for level in reversed(range(self.order)):
            part = x.reshape(len(rows), 1 << level, 2, -1)
            a = part[:, :, 0].copy()
            b = part[:, :, 1] * self.inverse_roots[::1 << level] % prime
            part[:, :, 0], part[:, :, 1] = (a + b) % prime, (a + (prime - b)) % prime
        return x * self.scale % prime


def _digits(words: int, scale: int) -> tuple[int, int]:
    """Bits of a digit and number of digits, so that sums of `scale` squared differences stay below the prime."""
    bits = 16
    while True:
        count = max(1, -(-words.bit_length() // bits))
        if count * scale << 2 * bits < PRIME:
            return bits, count
        bits -= 1


def occurrences(words: np.ndarray, starts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """For blocks words[s:s + scale]: the s and distances from scale to 2 * scale - 1 of their occurrences.

    words: whole numbers from 0, with 3 * scale values at least behind each start.
    """
    order, prime = (2 * scale).bit_length() - 1, np.uint64(PRIME)
    transform, size = Transform(order), 2 * scale
    bits, count = _digits(int(words.max(initial=0)), scale)
    found_starts, found_distances = [], []
    step = max(1, CHUNK_VALUES // size)
    for k in range(0, len(starts), step):
        own = starts[k:k + step]
        blocks = words[own[:, None] + np.arange(scale)].astype(np.uint64)
        # Distances scale to 2 * scale - 1 need 2 * scale - 1 values; the last one of the row plays no part.
        windows = words[own[:, None] + np.arange(scale, 3 * scale)].astype(np.uint64)
        total = np.zeros((len(own), scale), np.uint64)
        mixed = np.zeros((len(own), size), np.uint64)
        for digit in range(count):
            mask = np.uint64((1 << bits) - 1)
            a = blocks >> np.uint64(digit * bits) & mask
            b = windows >> np.uint64(digit * bits) & mask
            squares = np.concatenate((np.zeros((len(own), 1), np.uint64), np.cumsum(b * b, axis=1, dtype=np.uint64)), axis=1)
            total += (a * a).sum(axis=1, dtype=np.uint64)[:, None] + squares[:, scale:size] - squares[:, :scale]
            # The block from its end to its beginning, so that the product's value scale - 1 + j is the sum for j.
            reverse = np.zeros_like(b)
            reverse[:, :scale] = a[:, ::-1]
            mixed += transform.forward(reverse) * transform.forward(b) % prime
        products = transform.inverse(mixed % prime)[:, scale - 1:size - 1]
        zero = (total % prime + 2 * (prime - products)) % prime == 0
        at, distance = np.nonzero(zero)
        found_starts.append(own[at])
        found_distances.append(distance + scale)
    if not found_starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_starts), np.concatenate(found_distances)


class _Prefixes:
    """Hashes of all prefixes, to compare stretches of words."""

    def __init__(self, words: np.ndarray):
        self.words, self.hashes, self.powers = words, [], []
        for prime, base in zip(_MODULI, _BASES):
            powers = _powers(base, len(words) + 1, prime)
            values = (words.astype(np.uint64) + np.uint64(1)) * powers[:-1] % np.uint64(prime)
            # Sums of 2^31 values of 31 bits fit.
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64) % np.uint64(prime)))
            self.hashes.append(sums)
            self.powers.append(powers)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of `length` words at a and, behind it, at b have equal hashes."""
        same = np.ones(len(a), bool)
        for prime, sums, powers in zip(_MODULI, self.hashes, self.powers):
            p = np.uint64(prime)
            left = (sums[a + length] + (p - sums[a])) * powers[b - a] % p
            same &= left % p == (sums[b + length] + (p - sums[b])) % p
        return same

    def _longest(self, fits, most: np.ndarray) -> np.ndarray:
        """The longest length up to most that fits, by bisection."""
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fine = fits(middle)
            low, high = np.where(fine, middle, low), np.where(fine, high, middle - 1)
        return low

    def stretches(self, starts: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the stretch around each start within which words keep equal at the distance."""
        right = self._longest(lambda n: self.equal(starts, starts + distances, n), len(self.words) - starts - distances)
        left = self._longest(lambda n: self.equal(starts - n, starts + distances - n, n), starts)
        return starts - left, starts + right + distances


def _prime_factors(number: int) -> list[int]:
    out, factor = [], 2
    while factor * factor <= number:
        if number % factor == 0:
            out.append(factor)
            while number % factor == 0:
                number //= factor
        factor += 1
    return out + [number] * (number > 1)


def _covered(runs: np.ndarray, starts: np.ndarray, distances: np.ndarray, scale: int) -> np.ndarray:
    """Whether a block and its copy lie in a run found before whose period divides the distance: the stretch is
    that run, or has its period and is too short."""
    if not len(runs) or not len(starts):
        return np.zeros(len(starts), bool)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    # Runs of one period overlap by less than it, so each period's runs are in order of their ends too.
    out = np.zeros(len(starts), bool)
    for period in np.unique(runs[:, 2]):
        if period >= 2 * scale:
            continue
        own = runs[runs[:, 2] == period]
        at = np.searchsorted(own[:, 0], starts, "right") - 1
        inside = (at >= 0) & (starts + distances + scale <= own[at, 0] + own[at, 1])
        out |= inside & (distances % period == 0)
    return out


def find_runs(words: np.ndarray) -> np.ndarray:
    """Start, length and period of each run in an array of word numbers, by start, then period."""
    n = len(words)
    found = np.zeros((0, 3), np.int64)
    if n < LEAST_WORDS:
        return found
    # How far on each word recurs.
    order = np.argsort(words, kind="stable")
    gap = np.full(n, n, np.int64)
    again = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    prefixes = None
    scale = 1
    while LEAST_PERIODS * scale <= n:
        most = np.maximum.reduceat(gap, np.arange(0, n, scale))[:n // scale]
        starts = np.flatnonzero(most < 2 * scale) * scale
        if len(starts):
            # Behind the end no word is any of the others.
            padded = np.concatenate((words, np.full(3 * scale, words.max() + 1, words.dtype)))
            seeds, distances = occurrences(padded, starts, scale)
            new = ~_covered(found, seeds, distances, scale)
            seeds, distances = seeds[new], distances[new]
            if len(seeds):
                prefixes = prefixes or _Prefixes(words)
                begin, end = prefixes.stretches(seeds, distances)
                stretches = np.unique(np.stack((begin, end, distances), axis=1), axis=0)
                length = stretches[:, 1] - stretches[:, 0]
                own = []
                for b, e, d in stretches[length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * stretches[:, 2])].tolist():
                    same = lambda q: bool((words[b:e - q] == words[b + q:e]).all())  # noqa: E731, B023
                    if not same(d):
                        raise ValueError("two different stretches of words share their hashes")
                    if not any(same(d // f) for f in _prime_factors(d)):
                        own.append((b, e - b, d))
                if own:
                    found = np.concatenate((found, np.array(own, np.int64)))
        scale *= 2
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _together(texts: list[bytes]) -> Iterator[tuple[list[list[bytes]], np.ndarray]]:
    """For each text its words and its runs; several texts are searched as one array."""
    numbers: dict[bytes, int] = {}
    split = [t.split() for t in texts]  # cuts at 09-0D and 20
    pieces, begins, at = [], [], 0
    for number, own in enumerate(split):
        begins.append(at)
        pieces.extend(numbers.setdefault(w, len(numbers)) for w in own)
        pieces.append(-1 - number)
        at += len(own) + 1
    words = np.array(pieces, np.int64)
    ends = words < 0
    words[ends] = len(numbers) - 1 - words[ends]  # one of its own behind each text
    runs = find_runs(words)
    cuts = np.searchsorted(runs[:, 0], [*begins, at])
    for own, begin, a, b in zip(split, begins, cuts, cuts[1:]):
        yield own, runs[a:b] - [begin, 0, 0]


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `runs`, an array of (start, length, period) by start, then period, and `collapsed`, the kept words
    joined by single blanks; both replace columns of these names.

    Words stand between 09-0D and 20 and are compared byte by byte. A run is a stretch of consecutive words with the smallest
    period q, at least LEAST_WORDS words and LEAST_PERIODS periods long, that no word to its left or right extends keeping
    period q. Runs of different periods may overlap. A word goes if a run contains it after the run's first q words; blanks are
    not kept as they were. A null, empty or blank text has no runs and collapses to the empty text. Repeated rows, null and
    repeated keys and other columns pass through; an empty table gives an empty table. A text is searched whole, whatever its
    length up to 2^22 words, beyond which the transform has no roots.
    """
    docs = docs.drop("runs", "collapsed")
    place = docs.columns.index(text)
    run_type = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
    schema = T.StructType([*docs.schema.fields, T.StructField("runs", run_type), T.StructField("collapsed", T.StringType())])

    def done(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        offsets, flat, collapsed = [0], [], []
        for own, runs in _together(texts):
            flat.append(runs)
            offsets.append(offsets[-1] + len(runs))
            if len(runs):
                inner = np.zeros(len(own) + 1, np.int64)
                np.add.at(inner, runs[:, 0] + runs[:, 2], 1)
                np.add.at(inner, runs[:, 0] + runs[:, 1], -1)
                own = [w for w, inside in zip(own, np.cumsum(inner).tolist()) if not inside]
            collapsed.append(b" ".join(own))
        flat = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
        runs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"])
        new = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), pa.array(collapsed, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, held, size = 0, [], 0
            for k, value in enumerate(batch.column(place).cast(pa.binary())):
                own = value.as_py() or b""
                if held and size + len(own) > 6 * CHUNK_WORDS:
                    yield done(batch.slice(begin, k - begin), held)
                    begin, held, size = k, [], 0
                held.append(own)
                size += len(own)
            if held:
                yield done(batch.slice(begin), held)

    return docs.mapInArrow(run, schema)


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and the words of each text as `text`; where crc32(doc_id as text) is divisible by ten, the words from number
    a on are made periodic: word i becomes word a + (i - a) % p, with g = crc32 div 10, a = g % n, p = 1 + (n - a) div
    (3 + g % 8) for a text of n words. A null doc_id changes nothing."""
    blanks = " \t\n\x0b\x0c\r"
    split = F.split(F.btrim("text", F.lit(blanks)), "[ \t-\r]+")
    words = F.when(F.btrim("text", F.lit(blanks)) == "", F.array().cast("array<string>")).otherwise(split)
    own = materialized(docs.select("doc_id", "text"), F.coalesce(words, F.array().cast("array<string>")), "words", "doc_id")
    h, n = F.crc32(F.col("doc_id").cast("string")), F.size("words")
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    made = own.select("doc_id", "words", *[F.when((h % 10 == 0) & (n > 0), x).alias(name) for name, x in (("a", a), ("p", p))])
    # a and p are computed once a row, as a generator of one row stands between.
    each = made.select("doc_id", "words", F.explode(F.array(F.struct("a", "p"))).alias("at"))
    first, period = F.col("at.a"), F.col("at.p")
    periodic = F.transform("words", lambda w, i: F.when(i < first, w).otherwise(F.get("words", first + (i - first) % period)))
    return each.select("doc_id", F.array_join(F.when(first.isNull(), F.col("words")).otherwise(periodic), " ").alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and digests of all runs and of the kept words."""
    found = periodic_runs(with_periods(docs))
    longest = F.get(F.transform(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))),
        lambda r: F.struct(r["start"].alias("start"), (-r["less"]).alias("length"), r["period"].alias("period"))), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "r.start", "r.length", "r.period",
                    F.floor(1000 * F.col("r.length") / F.col("r.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))
