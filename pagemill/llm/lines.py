"""Cross-site boilerplate lines: HyperLogLog sketches of the sites per line, exact counts near the threshold.

Built from DataFrame functions only. Sketches combine before the shuffle, so a line that stands in a third of all
documents is one row per task. Line texts are not shuffled but for the few lines near the threshold.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.shared import written

#: A line on so many different sites is boilerplate.
MIN_SITES = 10
#: Sketches of 2^12 registers have a standard error of 1.6 %; estimates within six of these, and within one site, are
#: counted exactly.
LG_K, NEAR = 12, 0.1
#: Occurrences of one line are dealt to so many tasks.
PIECES = 16
#: With more boilerplate lines than this their first places are not broadcast: Spark sizes them as if each stood in one piece.
FEW_LINES = 4_096
_KEY = ["h1", "h2"]


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, version, site, pos, line and its 128-bit key, for every line that is not blank."""
    return (docs.select("doc_id", "version", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .where(F.trim("line") != "")
            .withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line")))


def boilerplate(docs: DataFrame, min_sites: int) -> DataFrame:
    """h1, h2 of the lines that stand on min_sites different sites or more."""
    lines = _lines(docs)
    spread = (lines.groupBy(*_KEY).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
              .where(F.col("sites") >= min(min_sites - 1, min_sites * (1 - NEAR))))
    spread = written(spread, "spread")
    near = F.col("sites") <= max(min_sites + 1, min_sites * (1 + NEAR))
    # Counted per line text, not per hash: two lines of one hash would be told apart here.
    exact = (lines.join(spread.where(near), _KEY, "left_semi").select(*_KEY, "line", "site").distinct()
             .groupBy(*_KEY, "line").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites).select(*_KEY).distinct())
    return spread.where(~near).select(*_KEY).union(exact)


def remove_boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                       min_sites: int = MIN_SITES) -> DataFrame:
    """docs with `text` cleaned, and `n_lines` and `n_removed`, which replace columns of these names.

    A line is what stands between line feeds, compared exactly. Every occurrence of a boilerplate line goes but the
    first one (smallest doc_id, null last, then position), so that no content leaves the corpus altogether. Blank lines are
    never removed. A null text stays null and has 0 lines, an empty text has one empty line. Rows with a null site count for
    no site but lose lines like others; rows with a null doc_id do too. Repeated rows are treated alike: the
    first occurrence stays in each of them. Other columns pass through. An empty table gives an empty table.
    """
    docs = docs.drop("n_lines", "n_removed")
    columns = docs.columns
    # Numbered, so that no column of docs can clash with those below.
    docs = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    doc_id, text, site = (f"c{columns.index(c)}" for c in (doc_id, text, site))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(site).alias("site"),
                      F.xxhash64(F.lit(2), text).alias("version"))
    flagged = written(boilerplate(own, min_sites), "boilerplate")
    seen = _lines(own).join(flagged, _KEY).select(*_KEY, "doc_id", "version", "pos")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version", "pos")
    # A line that stands in a third of all documents is a few partial rows here; its first places then meet its
    # occurrences in pieces dealt by document, not in one task of the line.
    firsts = seen.groupBy(*_KEY).agg(F.min(place).alias("first")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    if flagged.count() > FEW_LINES:
        firsts = firsts.hint("merge")
    dealt = seen.withColumn("piece", F.pmod(F.xxhash64("doc_id", "version"), F.lit(PIECES)).cast("int"))
    gone = (dealt.join(firsts, [*_KEY, "piece"]).where(place != F.col("first"))
            .groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
            .select(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version"), "gone"))
    split = docs.withColumn("version", F.xxhash64(F.lit(2), text)).withColumn("lines", F.split(text, "\n")).drop(text)
    joined = split.join(gone, F.col(doc_id).eqNullSafe(F.col("gone_id")) & (F.col("version") == F.col("gone_version")), "left")
    # What stands between two removed lines is one slice, so the work is linear in the lines.
    n = F.size("gone")
    begin = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get("gone", k - 1) + 1)
    end = lambda k: F.when(k == n, F.size("lines")).otherwise(F.get("gone", k))
    rest = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda k: F.slice("lines", begin(k) + 1, end(k) - begin(k))))
    cleaned = F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(rest), "\n")
    return joined.select(
        *[(cleaned if f"c{i}" == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(columns)],
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(n).cast("long").alias("n_removed"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, text_sha256 (of the cleaned text) of each document."""
    return (remove_boilerplate(docs.select("doc_id", "text", "source"))
            .select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")))


#: The same by definition, for DuckDB.
SQL = f"""
with docs as (select row_number() over () as r, doc_id, source, text, string_split(text, chr(10)) as ls from documents),
places as (select r, doc_id, source, ls, unnest(range(1, len(ls) + 1)) as p from docs where text is not null),
lines as (select r, doc_id, source, p, ls[p] as line from places where trim(ls[p]) <> ''),
flagged as (select line, min((doc_id, p)) as first from lines group by line having count(distinct source) >= {MIN_SITES}),
gone as (select r, p from lines join flagged using (line) where (doc_id, p) <> first),
lost as (select r, list(p) as ps from gone group by r)
select doc_id, coalesce(len(ls), 0)::bigint as n_lines, coalesce(len(ps), 0)::bigint as n_removed,
       sha256(case when ps is null then text else array_to_string(
         list_filter(list_transform(ls, lambda x, i: case when list_contains(ps, i) then null else x end), lambda x: x is not null), chr(10)) end) as text_sha256
from docs left join lost using (r)
"""
