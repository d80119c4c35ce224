"""Removal of repeated passages: count-min prefilter over word windows, then exact grouping.

Documents are dealt into blocks by a hash; a block is one task's work and the unit of every message.
  1. Each block builds a count-min sketch of its windows: `DEPTH` rows of counters that saturate at 2, of
     width 32 times the number of windows of the corpus or more. Most counters are 0, so a row is stored
     as its sorted occupied cells, cut into slices of the cell range. Slices of all blocks are merged
     by cell, and each block is told which of its cells are counted twice or more.
  2. A window whose cells are all counted twice is a candidate. Estimates are never too low, so no
     repeated window is missed; about one in a thousand other windows comes along. Each block sends its
     different candidates (128-bit hash, smallest doc_id), cut into slices again; per hash the smallest
     doc_id of all blocks is found, and each block is told for which hashes another block has a smaller one.
  3. Each block removes the words and gives one row per document.
A passage that stands in very many documents is one entry per block, so it makes no task larger than
others. The blocks' texts are shuffled once; the three steps read that same exchange.
"""

import math
from functools import partial

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 13
#: Bytes of text in a block, windows in a slice, and least number of either. A worker needs about ten times
#: a block. With larger executors both can grow: blocks times slices is the number of messages.
BLOCK_BYTES, SLICE_WINDOWS, LEAST_PARTS = 16 << 20, 4 << 20, 64
#: Rows of the sketch, and bits of width beyond the number of windows: 2 rows of 1/32 load.
DEPTH, SPARE_BITS = 2, 5
_MIX = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _windows(text: bytes, size: int) -> tuple[list[bytes], np.ndarray]:
    """Words, and two 64-bit halves of the hash of each window."""
    words = text.split()  # at 09-0D and 20
    n = len(words) - size + 1
    if n <= 0:
        return words, np.empty((0, 2), np.uint64)
    joined = b" ".join(words)
    starts = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    ends = (starts[size - 1:] - 1).tolist()
    starts = [0, *starts[:n - 1].tolist()]
    digest = xxhash.xxh3_128_digest
    return words, np.frombuffer(b"".join([digest(joined[i:j]) for i, j in zip(starts, ends)]), "<u8").reshape(-1, 2)


def _block(rows: pd.DataFrame, size: int):
    """Words of each document, hashes of all windows, and the document (row number) of each."""
    found = [_windows(t if t is not None else b"", size) for t in rows["text"]]
    counts = [len(h) for _, h in found]
    return ([w for w, _ in found], np.concatenate([h for _, h in found]),
            np.repeat(np.arange(len(rows)), counts), counts)


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (hashes[:, 0] * _MIX[row]) >> np.uint64(64 - bits)


def _sliced(values: np.ndarray, bits: int, slice_bits: int) -> np.ndarray:
    """Where each slice of sorted values begins, and the end."""
    edges = np.arange(1 << slice_bits, dtype=np.uint64) << np.uint64(bits - slice_bits)
    return np.append(np.searchsorted(values, edges), len(values))


def _packed(values: np.ndarray) -> bytes:
    """Byte planes of 64-bit numbers, compressed: small differences cost little."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)


def _sketch(rows: pd.DataFrame, size: int, bits: int, slice_bits: int) -> pd.DataFrame:
    """Occupied cells of one block's sketch; the lowest bit of each stored step says "twice or more"."""
    block, (_, hashes, _, _) = rows["block"].iat[0], _block(rows, size)
    out = []
    for row in range(DEPTH):
        cells, counts = np.unique(_cells(hashes, row, bits), return_counts=True)
        edges = _sliced(cells, bits, slice_bits)
        for k in np.flatnonzero(np.diff(edges)):
            own = cells[edges[k]:edges[k + 1]]
            steps = np.diff(own, prepend=np.uint64(k << (bits - slice_bits)))
            twice = (counts[edges[k]:edges[k + 1]] > 1).astype(np.uint64)
            out.append((block, row, k, _packed(steps << np.uint64(1) | twice)))
    return pd.DataFrame(out, columns=["block", "line", "slice", "data"])


def _merge_sketches(rows: pd.DataFrame, bits: int, slice_bits: int) -> pd.DataFrame:
    """Adds the counters of a slice over all blocks; tells each block which of its cells reach two."""
    line, k = rows["line"].iat[0], rows["slice"].iat[0]
    cells, twice = [], []
    for data in rows["data"]:
        coded = _unpacked(data)
        cells.append(np.cumsum(coded >> np.uint64(1), dtype=np.uint64) + np.uint64(int(k) << (bits - slice_bits)))
        twice.append(coded & np.uint64(1) == 1)
    every = np.sort(np.concatenate(cells + [c[t] for c, t in zip(cells, twice)]))
    full = every[1:][every[1:] == every[:-1]]  # once per block, once more where twice in it
    masks = [np.packbits(_among(c, full)).tobytes() for c in cells]
    return pd.DataFrame({"block": rows["block"], "line": line, "slice": k, "mask": masks})


def _among(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    if not len(members):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(members, values), len(members) - 1)
    return members[at] == values


def _mask(masks: pd.DataFrame, line: int, sizes: np.ndarray) -> np.ndarray:
    """The bits sent back for one line, slice by slice in the order of the sorted values."""
    own = masks[masks["line"] == line].sort_values("slice")
    parts = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(own["mask"], sizes[sizes > 0])]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _candidates(hashes: np.ndarray, masks: pd.DataFrame, bits: int, slice_bits: int) -> np.ndarray:
    """Numbers of the windows that the merged sketch estimates at two or more."""
    chosen = np.ones(len(hashes), bool)
    for row in range(DEPTH):
        cells, number = np.unique(_cells(hashes, row, bits), return_inverse=True)
        chosen &= _mask(masks, row, np.diff(_sliced(cells, bits, slice_bits)))[number]
    return np.flatnonzero(chosen)


def _keys(hashes: np.ndarray, ids: np.ndarray):
    """Different hashes in order, the number of each hash among them, the smallest id of each."""
    if not len(hashes):
        return hashes, np.zeros(0, np.int64), ids
    order = np.argsort(hashes[:, 0], kind="stable")
    ranked = hashes[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:, 0] != ranked[:-1, 0]
    if (ranked[1:, 1] != ranked[:-1, 1])[~new[1:]].any():  # equal in the first half only
        order = np.lexsort((hashes[:, 1], hashes[:, 0]))
        ranked = hashes[order]
        new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    number = np.empty(len(ranked), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], number, np.minimum.reduceat(ids[order], np.flatnonzero(new))


def _repeated(rows: pd.DataFrame, masks: pd.DataFrame, size: int, bits: int, slice_bits: int):
    """What steps 2 and 3 share: candidates with a doc_id, their documents, and their different hashes."""
    words, hashes, owner, counts = _block(rows, size)
    chosen = _candidates(hashes, masks, bits, slice_bits)
    ids, named = rows["doc_id"].to_numpy(np.int64), rows["named"].to_numpy(bool)
    chosen = chosen[named[owner[chosen]]]
    keys, number, least = _keys(hashes[chosen], ids[owner[chosen]])
    return words, counts, chosen, ids[owner[chosen]], keys, number, least


def _send(rows: pd.DataFrame, masks: pd.DataFrame, size: int, bits: int, slice_bits: int) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"block": [], "slice": [], "data": []})
    *_, keys, _, least = _repeated(rows, masks, size, bits, slice_bits)
    edges = _sliced(keys[:, 0], 64, slice_bits)
    out = [(rows["block"].iat[0], k, keys[edges[k]:edges[k + 1]].tobytes() + least[edges[k]:edges[k + 1]].tobytes())
           for k in np.flatnonzero(np.diff(edges))]
    return pd.DataFrame(out, columns=["block", "slice", "data"])


def _merge_keys(rows: pd.DataFrame) -> pd.DataFrame:
    """Smallest doc_id per hash over all blocks; tells each block where another has a smaller one."""
    parts = [np.frombuffer(d, np.int64) for d in rows["data"]]
    sizes = [len(p) // 3 for p in parts]
    keys = np.concatenate([p[:2 * n].view(np.uint64).reshape(-1, 2) for p, n in zip(parts, sizes)])
    own = np.concatenate([p[2 * n:] for p, n in zip(parts, sizes)])
    _, number, least = _keys(keys, own)
    smaller = np.split(least[number] < own, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"block": rows["block"], "line": DEPTH, "slice": rows["slice"],
                         "mask": [np.packbits(s).tobytes() for s in smaller]})


def _remove(rows: pd.DataFrame, masks: pd.DataFrame, size: int, bits: int, slice_bits: int) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"doc_id": [], "named": [], "n_words": [], "n_removed": [], "kept": []})
    words, counts, chosen, ids, keys, number, least = _repeated(rows, masks, size, bits, slice_bits)
    elsewhere = _mask(masks, DEPTH, np.diff(_sliced(keys[:, 0], 64, slice_bits)))
    gone = np.zeros(sum(counts), bool)
    gone[chosen[elsewhere[number] | (least[number] < ids)]] = True
    kept, removed, start = [], [], 0
    for own, n in zip(words, counts):
        steps = np.zeros(len(own) + 1, np.int64)
        if n:
            steps[:n] += gone[start:start + n]
            steps[size:size + n] -= gone[start:start + n]
        start += n
        covered = np.cumsum(steps)[:-1] > 0
        removed.append(int(covered.sum()))
        kept.append(b" ".join([w for w, c in zip(own, covered.tolist()) if not c]) if removed[-1] else b" ".join(own))
    return pd.DataFrame({"doc_id": rows["doc_id"], "named": rows["named"], "n_words": [len(w) for w in words],
                         "n_removed": removed, "kept": kept})


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW_WORDS,
                   block_bytes: int = BLOCK_BYTES, slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (string): one row per row of docs.

    A word goes if a window of `size` consecutive words that holds it has a word sequence that also
    starts in a document with a smaller doc_id. Windows are judged on the input. Words are what stands
    between blanks (09-0D, 20), unchanged; kept words are joined by one space. Null and empty texts
    and texts shorter than a window keep all they have. A row with a null doc_id keeps its words and
    takes none from others. Rows that repeat a doc_id keep windows of each other. Other columns of docs
    play no part. An empty table gives an empty table.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    n_bytes = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, math.ceil(n_bytes / block_bytes))
    windows = max(1, n_bytes // 2)  # a word takes two bytes with its blank at least
    bits = min(60, math.ceil(math.log2(windows)) + SPARE_BITS - 1)
    slice_bits = min(bits, math.ceil(math.log2(max(LEAST_PARTS, windows / 2 / slice_windows))))
    # Rows of one doc_id may be many or null: the text deals them out as well.
    # A null doc_id would turn the column into floating numbers in pandas, so its place is taken by 0.
    blocks = (base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))
              .select("block", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                      F.col("doc_id").isNotNull().alias("named"), "text")
              .repartition(parts, "block"))
    args = {"size": size, "bits": bits, "slice_bits": slice_bits}
    sent = blocks.groupBy("block").applyInPandas(
        partial(_sketch, **args), "block int, line int, slice int, data binary")
    full = sent.groupBy("line", "slice").applyInPandas(
        partial(_merge_sketches, bits=bits, slice_bits=slice_bits), "block int, line int, slice int, mask binary")
    told = full.repartition(parts, "block")
    candidates = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(
        partial(_send, **args), "block int, slice int, data binary")
    smaller = candidates.groupBy("slice").applyInPandas(_merge_keys, "block int, line int, slice int, mask binary")
    both = full.union(smaller).repartition(parts, "block")
    out = blocks.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(
        partial(_remove, **args), "doc_id long, named boolean, n_words long, n_removed long, kept binary")
    return out.select(F.when(F.col("named"), F.col("doc_id")).alias("doc_id"), "n_words", "n_removed",
                      F.col("kept").cast("string").alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The same by definition, for DuckDB.
SQL = r"""
with words as (
  select row_number() over () as r, doc_id,
         coalesce(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> ''), []) as w
  from documents),
starts as (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13),
windows as (select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as k from starts),
firsts as (select k, min(doc_id) as f from windows group by k),
gone as (select distinct r, unnest(range(i, i + 13)) as p from windows join firsts using (k) where f < doc_id),
lost as (select r, list(p) as ps from gone group by r),
kept as (
  select words.r, doc_id, len(w) as n_words, coalesce(len(ps), 0) as n_removed,
         case when ps is null then w
              else list_filter(list_transform(w, lambda x, i: case when list_contains(ps, i) then null else x end), lambda x: x is not null)
         end as k
  from words left join lost using (r))
select doc_id, n_words::bigint as n_words, n_removed::bigint as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
"""
