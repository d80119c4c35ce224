"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash."""

from pyspark.sql import DataFrame

from pagemill.llm.minhash import BANDS, CONTAINMENT, SHINGLE_WORDS, contained


def contaminated(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", size: int = SHINGLE_WORDS,
                 containment: float = CONTAINMENT, bands: int = BANDS) -> DataFrame:
    """doc_id, item_id, n_found, n_item, containment of each document that holds a test item.

    See minhash.contained: five-word shingles of lower-case words, at least 0.8 of the item's different
    shingles, whole texts. Nulls, empty texts, repeated rows and empty tables as described there.
    """
    return contained(docs, benchmark, "doc_id", item, size=size, containment=containment,
                     bands=bands).withColumnRenamed("item", "item_id")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no test item, with their columns. Rows with a null doc_id can't be
    named in a result and stay."""
    found = contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


#: The same by definition, for DuckDB.
SQL = r"""
with worded as (
  select 'd' as kind, doc_id as id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') as w from documents
  union all
  select 'b', item_id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') from benchmark),
starts as (select kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from worded where len(w) > 0),
shingles as (select distinct kind, id, array_to_string(w[i:i + 4], ' ') as s from starts),
sizes as (select id, count(*) as n_item from shingles where kind = 'b' group by id),
hits as (select d.id as doc_id, b.id as item_id, count(*) as n_found
         from shingles d join shingles b on d.s = b.s where d.kind = 'd' and b.kind = 'b' group by all)
select doc_id, item_id, n_found, n_item, n_found / n_item as containment
from hits join sizes on sizes.id = item_id where n_found >= n_item * 0.8
"""
