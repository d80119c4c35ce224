"""Quality rules: plain counts of each text, and a hashed n-gram log-likelihood ratio between two multinomials.

Words and pairs of neighbouring words fall into buckets by a hash. One multinomial over the buckets is estimated from all
documents, the other from the trusted ones, both with the same additive share. A text's score is the mean over its n-grams
of the log ratio of target to raw probability; texts below the threshold are not kept. Every text is judged, none is
drawn. Log ratios are whole millionths, so a sum does not depend on the order of its terms.

Built from DataFrame functions only. Counts combine before the shuffle to one row per bucket and task; the ratios are one
array of BUCKETS numbers, a constant of the scoring expression, so scoring shuffles nothing.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import let
from pagemill.llm.shared import materialized

BUCKETS = 1 << 14
#: Added to each bucket's count in both models.
SHARE = 8.0
#: Least mean log ratio of a text that is kept, in millionths.
LEAST_RATIO = -90_000
#: Base rules: least words, most percent of words in repeated windows, words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Ids of trusted documents are broadcast up to this number; more of them are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Blanks that separate words, and the hash of a pair of words by their CRC-32 numbers.
_BLANKS = " \t\n\x0b\x0c\r"
_FIRST, _SECOND, _PRIME = 1_000_003, 7_919, 4_294_967_291
_MILLION = 1_000_000


def _words(text: Column) -> Column:
    """Words of a text, none for null."""
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, "[ \t-\r]+")).otherwise(F.array().cast("array<string>"))


def _buckets(hashes: str) -> Column:
    """Buckets of the words and of the pairs of neighbours, from the words' CRC-32 numbers."""
    n = F.greatest(F.size(hashes) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(2), n), lambda a, b: ((a * _FIRST + b * _SECOND) % _PRIME % BUCKETS).cast("int"))
    return F.concat(F.transform(hashes, lambda h: (h % BUCKETS).cast("int")), pairs)


def _ratios(words: DataFrame, trusted: DataFrame) -> list[int]:
    """Log ratio of target to raw probability of each bucket in millionths; words: doc_id, words, of all documents."""
    ids = trusted.select("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(1))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    marked = words.join(ids, "doc_id", "left").select("target", F.transform("words", lambda w: F.crc32(w)).alias("hashes"))
    counts = (materialized(marked, F.col("hashes"), "hashes", "target").select("target", F.explode(_buckets("hashes")).alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("target").alias("own")))
    found = {r["bucket"]: (r["raw"], r["own"]) for r in counts.collect()}
    rows = [found.get(bucket, (0, 0)) for bucket in range(BUCKETS)]
    raw, target = (sum(column) + SHARE * BUCKETS for column in zip(*rows))
    return [math.floor(_MILLION * math.log((b + SHARE) / target / ((a + SHARE) / raw)) + 0.5) for a, b in rows]


def _repeated(windows: Column) -> Column:
    """Words that lie in windows found twice or more, from the hashes of the windows at each word."""
    def places(ordered):
        same = lambda x, k: F.get(ordered, k)["h"].eqNullSafe(x["h"])
        return F.sort_array(F.transform(F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

    def covered(at):
        return F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda total, x: total + x)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        let(let(ordered, places), covered))


def judge(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept: a row per row of docs.

    Words stand between 09-0D and 20. word_chars: code points in words; n_symbols: characters of #*$%&|<>; n_dup_lines: lines
    between line feeds that hold a word and equal an earlier one; n_repeat_words: words in windows of eight words found
    twice or more in the text, the first included (windows are compared by 64-bit hashes). base_failed: under 20 words or over 30 %
    of them repeated. score: the mean log ratio of the text's n-grams, null without words. kept: not base_failed
    and a score of LEAST_RATIO millionths or more; a text exactly at a bound is kept.

    trusted: doc_id of the target documents, part of docs; null ids are left out, of repeated ones each counts once. Without
    any, target probabilities are equal. Null, empty and blank texts have no words and fail. Rows with a null doc_id count for the raw
    corpus and are judged; repeated rows count and are judged each. Other columns play no part. An empty table gives an empty table.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ratios = _ratios(own.select("doc_id", _words(F.col("text")).alias("words")), trusted)
    weights = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<bigint>")  # folded to one constant

    split = materialized(own, _words(F.col("text")), "words", "doc_id", "text")
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(_BLANKS))) > 0)
    counted = split.select(
        "doc_id", F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")), F.lit(0)).cast("long").alias("n_symbols"),
        F.coalesce(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.crc32(w)).alias("crc"), F.transform("words", lambda w: F.xxhash64(w)).alias("word"))
    counts = ["doc_id", "n", "word_chars", "n_symbols", "n_dup_lines"]
    hashed = materialized(counted, F.struct("crc", "word"), "h", *counts).select(*counts, "h.crc", "h.word")
    windows = F.when(F.col("n") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("n") - WINDOW),
        lambda i: F.xxhash64(*[F.get("word", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(_buckets("crc"), F.lit(0).cast("long"), lambda s, b: s + F.get(weights, b))
    scored = materialized(hashed, F.struct(windows.alias("windows"), total.alias("total")), "s", *counts)
    n, grams = F.col("n"), F.greatest(2 * F.col("n") - 1, F.lit(0))
    ready = scored.select(*counts, _repeated(F.col("s.windows")).alias("n_repeat_words"), F.col("s.total").alias("total"))
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)
    return ready.select(
        "doc_id", n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.when(grams > 0, F.col("total") / grams / _MILLION).alias("score"),
        (~failed & (F.col("total") >= grams.cast("long") * LEAST_RATIO)).alias("kept"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdicts of all documents; those labelled to be of good quality are the target."""
    return judge(docs, labels.where("quality = 1")).drop("score")


#: The same by definition, for DuckDB: windows are compared word by word, CRC-32 is computed bit by bit for each different word.
SQL = f"""
with docs as (select row_number() over () as r, doc_id, text from documents),
split as (select r, doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from docs),
flat as (select r, doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as i from split),
bits as (select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
different as (select w, hex(encode(w)) as x from (select distinct w from flat)),
crc as (select w, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(x) // 2),
  lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) as h
  from different, bits),
hashed as (select r, doc_id, i, h, lead(h) over (partition by r order by i) as g from flat join crc using (w)),
grams as (select r, doc_id, h % {BUCKETS} as b from hashed
  union all select r, doc_id, (h * {_FIRST} + g * {_SECOND}) % {_PRIME} % {BUCKETS} from hashed where g is not null),
trusted as (select distinct doc_id from labels where quality = 1 and doc_id is not null),
counts as (select n.b, count(g.b) as raw, count(t.doc_id) as own
  from (select unnest(range({BUCKETS})) as b) n left join grams g using (b) left join trusted t using (doc_id) group by n.b),
totals as (select sum(raw) + {SHARE * BUCKETS} as raw, sum(own) + {SHARE * BUCKETS} as own from counts),
ratios as (select b, floor({_MILLION} * ln((c.own + {SHARE}) / t.own / ((c.raw + {SHARE}) / t.raw)) + 0.5)::bigint as v from counts c, totals t),
scores as (select r, sum(v)::bigint as total, count(*) as grams from grams join ratios using (b) group by r),
windows as (select r, i, list(w) over (partition by r order by i rows between current row and {WINDOW - 1} following) as x from flat),
twice as (select r, unnest(spots) as i from (select r, list(i) as spots from windows where len(x) = {WINDOW} group by r, x having count(*) > 1)),
repeated as (select r, count(distinct i + k) as n from twice, unnest(range({WINDOW})) as s(k) group by r),
found as (select s.doc_id, len(ws)::bigint as n_words, coalesce(length(array_to_string(ws, '')), 0)::bigint as word_chars,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::bigint as n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words, total, grams
  from split s left join repeated using (r) left join scores using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed,
  not (n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words) and total >= grams * ({LEAST_RATIO}) as kept
from found"""
