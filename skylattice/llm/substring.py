"""Substring dedup with difference-cover anchors.

A window of 35 words is a repeat if its words start anywhere else as well. Short anchor
windows are hashed only where the position modulo 21 is in the difference cover
{0, 1, 4, 14, 16}: any two positions have a shift below 21 at which both are in the cover,
so two equal 35-word windows share an aligned anchor of 15 words. Anchors that occur once
rule out the windows around them; around the others, the match is extended to the whole
35-word windows, which are compared by 128-bit hashes.

Documents are dealt to blocks by hash. A block sends each of its different hashes once,
packed by hash range, with a mark if it has it more than once; so a passage that many
documents share costs one entry per block, not one per document. Only hashes that occur
elsewhere come back.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm.text import (
    block_count, blocked, borders, documents, hash_table, hashes, mix, window_hashes, words_of,
)

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
BUCKET_BLOCKS = 8  # blocks whose hashes make up one bucket, on average

# Hashes travel as arrays (n, lanes): one lane for anchors, which only rule out, and two for
# the windows that decide.


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows, sorted by their first lane, and how often each occurs."""
    order = np.argsort(rows[:, 0])
    s = rows[order]
    same = s[1:, 0] == s[:-1, 0]
    if (same & (s[1:] != s[:-1]).any(1)).any():
        s = rows[np.lexsort(rows.T[::-1])]
    first = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]).any(1)])) if len(s) else np.empty(0, np.int64)
    return s[first], np.diff(np.append(first, len(s)))


def member(values: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Which rows of ``values`` are among ``kept``, which is distinct and sorted."""
    if not len(kept):
        return np.zeros(len(values), bool)
    if len(kept) > 1 and (kept[1:, 0] == kept[:-1, 0]).any():
        known = set(map(tuple, kept.tolist()))
        return np.fromiter((tuple(v) in known for v in values.tolist()), bool, len(values))
    at = np.minimum(np.searchsorted(kept[:, 0], values[:, 0]), len(kept) - 1)
    return (kept[at] == values).all(1)


def unpack(column, lanes: int) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8").reshape(-1, lanes) for x in column.to_pylist()]


class Block:
    """The words of a block's documents as one array of hashes, with document borders."""

    def __init__(self, table: pa.Table):
        self.doc_ids = table.column("doc_id").to_pylist()
        self.words = [words_of(t) for t in table.column("text").to_pylist()]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        known = hash_table()
        self.h = np.concatenate([hashes(known, w) for w in self.words]) if len(sizes) else np.empty(0, np.uint64)
        self.offset = np.arange(len(self.h)) - np.repeat(self.starts, sizes)
        self.left = np.repeat(self.ends, sizes) - np.arange(len(self.h))

    def windows(self, length: int) -> np.ndarray:
        """Where windows of this length begin that stay inside their document."""
        return np.flatnonzero(self.left >= length)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the cover and the hashes of the anchors there."""
        length = window - PERIOD + 1
        at = self.windows(length)
        at = at[np.isin(self.offset[at] % PERIOD, COVER)]
        return at, window_hashes(self.h, length)[at][:, None]

    def candidates(self, window: int, repeated: np.ndarray) -> np.ndarray:
        """Windows with a repeated anchor; all of a window's own anchors lie inside it."""
        at, anchor = self.anchors(window)
        hit = at[member(anchor, repeated)]
        edge = np.zeros(len(self.h) + 1, np.int64)
        np.add.at(edge, np.maximum(hit - PERIOD + 1, 0), 1)
        np.add.at(edge, hit + 1, -1)
        near = np.cumsum(edge)[:-1] > 0
        at = self.windows(window)
        return at[near[at]]

    def keys(self, window: int, at: np.ndarray) -> np.ndarray:
        other = mix(self.h ^ np.uint64(0x5851F42D4C957F2D))
        return np.stack([window_hashes(h, window)[at] for h in (self.h, other)], 1)


def send(block: int, found: np.ndarray, buckets: int) -> pa.Table:
    """``bucket, block, once, more``: the different hashes of a block by hash range."""
    kept, count = distinct(found)
    at = borders(kept[:, 0], buckets)
    used = np.flatnonzero(np.diff(at))
    single = count == 1
    once, more = [], []
    for b in used:
        part, alone = kept[at[b] : at[b + 1]], single[at[b] : at[b + 1]]
        once.append(part[alone].tobytes())
        more.append(part[~alone].tobytes())
    return pa.table({
        "bucket": pa.array(used.astype(np.int32)),
        "block": pa.array(np.full(len(used), block, np.int32)),
        "once": pa.array(once, pa.binary()),
        "more": pa.array(more, pa.binary()),
    })


SENT = "bucket int, block int, once binary, more binary"


def repeats(sent: DataFrame, lanes: int) -> DataFrame:
    """``block, found``: the hashes of each block that occur more than once in the corpus."""

    def meet(table: pa.Table) -> pa.Table:
        once, more = unpack(table.column("once"), lanes), unpack(table.column("more"), lanes)
        kept, count = distinct(np.concatenate([*once, *more, *more]))
        kept = kept[count > 1]
        out = [np.concatenate([o[member(o, kept)], m]).tobytes() for o, m in zip(once, more)]
        found = pa.table({"block": table.column("block"), "found": pa.array(out, pa.binary())})
        return found.filter(pc.greater(pc.binary_length(found.column("found")), 0))

    return sent.groupBy("bucket").applyInArrow(meet, "block int, found binary")


def gather(table: pa.Table, lanes: int) -> np.ndarray:
    return distinct(np.concatenate([np.empty((0, lanes), np.uint64), *unpack(table.column("found"), lanes)]))[0]


def remove_repeats(docs: DataFrame, window: int = WINDOW, blocks: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per document.

    Every word covered by a repeated window goes, the first occurrence included. Windows are
    judged on the input and stay within one document. ``kept`` joins the kept words by one
    space. A null text has no words. Rows that repeat an id and text count as occurrences of
    their own. Other columns are ignored; an empty table gives no rows.
    """
    if window <= PERIOD:
        raise ValueError(f"the window must be longer than the period {PERIOD}")
    blocks = blocks or block_count(docs)
    buckets = blocks // BUCKET_BLOCKS + 1
    dealt = blocked(docs, blocks)

    def anchors(key, table):
        return send(key[0].as_py(), Block(table).anchors(window)[1], buckets)

    def extended(key, texts, found):
        if not texts.num_rows:
            return send(0, np.empty((0, 2), np.uint64), buckets)
        block = Block(texts)
        at = block.candidates(window, gather(found, 1))
        return send(key[0].as_py(), block.keys(window, at), buckets)

    def cut(key, texts, found):
        block = Block(texts)
        repeated = gather(found, 2)
        n, removed, kept = [], [], []
        gone = np.zeros(len(block.h), bool)
        if len(repeated):
            # only windows whose first lane occurs can match
            at = block.windows(window)
            at = at[member(window_hashes(block.h, window)[at][:, None], np.unique(repeated[:, :1], axis=0))]
            at = at[member(block.keys(window, at), repeated)]
            edge = np.zeros(len(block.h) + 1, np.int64)
            edge[at] += 1
            np.add.at(edge, at + window, -1)
            gone = np.cumsum(edge)[:-1] > 0
        for words, a, b in zip(block.words, block.starts, block.ends):
            out = gone[a:b]
            n.append(len(words))
            removed.append(int(out.sum()))
            if removed[-1]:
                words = [w for w, g in zip(words, out.tolist()) if not g]
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pa.table({
            "doc_id": pa.array(block.doc_ids, pa.int64()),
            "n_words": pa.array(n, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array(kept, pa.string()),
        })

    by_block = dealt.groupBy("block")
    shared = repeats(by_block.applyInArrow(anchors, SENT), 1)
    sent = by_block.cogroup(shared.groupBy("block")).applyInArrow(extended, SENT)
    shared = repeats(sent, 2)
    return by_block.cogroup(shared.groupBy("block")).applyInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


SQL = r"""
with w as (
  select doc_id, row_number() over (order by doc_id) as r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents),
s as (select r, i, list_aggregate(ws[i:i + 34], 'string_agg', ' ') as k
      from (select r, ws, unnest(range(1, len(ws) - 33)) as i from w)),
rep as (select r, i from (select r, i, count(*) over (partition by md5(k)) as n from s) where n > 1),
gone as (select distinct r, i + d as p from rep, (select unnest(range(0, 35)) as d)),
words as (select w.r, p, ws[p] as word from (select r, ws, unnest(range(1, len(ws) + 1)) as p from w) w),
kept as (select words.r, string_agg(word, ' ' order by p) as kept, count(*) as n
         from words anti join gone on words.r = gone.r and words.p = gone.p group by 1)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join kept using (r)
"""
