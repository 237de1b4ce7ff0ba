"""Words, hashes and blocks of documents, shared by the operators of this subpackage.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``. ``bytes.split()``
cuts UTF-8 at exactly these characters.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

BLOCK_CHARS = 2_000_000  # text in one block of documents: bounds what a task holds
KNOWN_WORDS = 500_000  # entries of a task's word table before it starts afresh
KNOWN_BYTES = 64  # words longer than this are not remembered


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text="text") -> Column:
    """The text as a string, a null one as the empty string."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def slices(batches, rows: int = 512):
    """The batches in slices of a few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class WordTable(dict):
    """Remembers a value per word; short words and few of them, so that its memory is bounded."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, word):
        if len(word) > KNOWN_BYTES:
            return self.value(word)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = self.value(word)
        return found


def hash_table() -> WordTable:
    return WordTable(xxhash.xxh3_64_intdigest)


def hashes(table: WordTable, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer; overflow wraps."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """One hash per window of ``length`` consecutive entries, by doubling.

    Empty if there are fewer entries than that. Windows over a concatenation of documents
    may cross their borders; the caller leaves those out.
    """
    if length > len(h):
        return np.empty(0, np.uint64)
    out, have, power, span = None, 0, h, 1
    while length:
        if length & 1:
            if out is None:
                out, have = power, span
            else:
                n = len(power) - have
                out = mix(out[:n] * np.uint64(3) + mix(power[have:]))
                have += span
        length >>= 1
        if length:
            power = mix(power[:-span] * np.uint64(5) + mix(power[span:]))
            span *= 2
    return out


def block_count(docs: DataFrame, chars: int = BLOCK_CHARS) -> int:
    """How many blocks of about ``chars`` characters the documents make (one narrow job)."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return int(total // chars) + 1


def blocked(docs: DataFrame, blocks: int, rest: bool = False) -> DataFrame:
    """``block, doc_id, text``: documents dealt to blocks by a hash of id and text.

    The block depends on the row alone, so a repeated or re-run task deals it alike. Rows
    with null ids are dealt by their texts. With ``rest``, a struct of that name carries
    all columns but the text.
    """
    text = whole()
    others = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")] if rest else []
    return docs.select(
        F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        *others,
    )


def packed(dealt: DataFrame) -> DataFrame:
    """``block, data``: the documents of each block in compressed pieces.

    A task packs what it reads of a block into one piece, so that texts are compressed before
    they are moved.
    """
    names = [c for c in dealt.columns if c != "block"]

    def pack(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.take(pc.sort_indices(batch.column("block")))
            block = batch.column("block").to_numpy()
            at = np.flatnonzero(np.diff(block, prepend=-1))
            rows, pieces = batch.select(names), []
            for a, b in zip(at, np.append(at[1:], len(block))):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    # a copy of the slice: else the buffers of the whole batch are written
                    writer.write_batch(rows.take(pa.array(np.arange(a, b))))
                pieces.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(block[at]), pa.array(pieces, pa.binary())], ["block", "data"])

    return dealt.mapInArrow(pack, "block int, data binary")


def unpacked(table: pa.Table) -> pa.Table:
    """The documents of a block from its pieces."""
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in table.column("data").to_pylist()])


def borders(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted hashes: bucket b is ``[at[b], at[b + 1])``.

    Buckets are ranges of the hash, so each holds an equal share of the different ones.
    """
    if buckets == 1:
        return np.array([0, len(values)])
    step = np.uint64((1 << 64) // buckets + 1)
    return np.searchsorted(values // step, np.arange(buckets + 1, dtype=np.uint64))


