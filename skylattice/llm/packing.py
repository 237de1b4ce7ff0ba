"""Packing of documents into fixed windows by non-negative least squares.

Documents are cut into whole windows and a rest. Lengths of rests fall into bins of
``STEP`` tokens. Shallow combinations of bins that fill a window are enumerated, repeat
counts of the combinations are fitted to the histogram of bins, rounded down, and what is
left of the histogram is packed greedily. All of this works on the histogram, whose size is
fixed. Pieces then get their places by their rank within their bin.
"""

import re
import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.llm.text import KNOWN_BYTES, WordTable, documents, slices
from skylattice.session import settle

WINDOW = 4096
STEP = 16  # tokens per bin: the most that a piece is padded by
DEPTH = 3  # pieces in an enumerated combination
END = 2  # id after each document
RANK_ROWS = 4_000  # pieces that are ranked in one task, about
KNOWN = 400_000  # words in each of an encoder's two generations
SPECIAL = b"<|"  # texts with this go through the tokenizer whole: special tokens may span words


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _plain_words(tokenizer):
    """A function from a plain word to its ids, or None where the word is not plain.

    Plain is a run of Latin letters, which stay as they are in NFC, and then marks: two
    pieces that go straight to the vocabulary's model once they are in lower case. None at
    all if the tokenizer does not treat such words so.
    """
    letters = [c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1 and ord(c.lower()) < 0x250]
    marks = ".,;:!?"
    try:
        spelled = {ord(c): tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
    except (AttributeError, IndexError):
        return None
    plain = re.compile(f"([{''.join(letters)}]+)([{marks}]*)")
    model = tokenizer.model

    def ids(word: str):
        found = plain.fullmatch(word)
        if not found:
            return None
        tokens = model.tokenize(found[1].lower().translate(spelled))
        return [t.id for t in tokens + (model.tokenize(found[2]) if found[2] else [])]

    probes = ("the", "Über,", "ÉTÉ!?", "niño", "ß", "Thstble.", "ŒUVRE;:")
    right = all(ids(w) == tokenizer.encode(w, add_special_tokens=False).ids for w in probes)
    return ids if right else None


class RecentWords(WordTable):
    """A word table that keeps what was asked for lately.

    A full generation becomes the old one, and words that are asked for again move to the
    new one, so that frequent words are never computed anew and memory stays bounded.
    """

    def __init__(self, value):
        super().__init__(value)
        self.old = {}

    def __missing__(self, word):
        found = self.old.get(word)
        if found is None:
            found = self.value(word)
            if len(word) > KNOWN_BYTES:
                return found
        if len(self) >= KNOWN:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


def encoder(path: str):
    """A function from a text to its ids as little-endian unsigned 32-bit integers.

    The tokenizer splits at white space before anything else, so words are encoded once and
    remembered, in bounded memory.
    """
    tokenizer = _tokenizer(path)
    plain = _plain_words(tokenizer)

    def whole(text):
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def one(word):
        text = word.decode()
        ids = plain(text) if plain else None
        return whole(text) if ids is None else struct.pack(f"<{len(ids)}I", *ids)

    known = RecentWords(one)

    def encode(text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        if SPECIAL in data:
            return whole(data.decode())
        return b"".join(map(known.__getitem__, data.split()))

    return encode


def pieces(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` for each piece of each document.

    A null text counts as empty: its only id is the one that ends a document.
    """
    end = np.array([END], "<u4").tobytes()

    def cut(batches):
        encode = encoder(path)
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text or "") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    out.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(bins: int) -> list[tuple[int, ...]]:
    """All multisets of at most ``DEPTH`` bins that fill ``bins`` exactly, largest first."""
    found = [(bins,)]
    for a in range(1, bins):
        if 2 * a >= bins:
            found.append((a, bins - a))
        for b in range(1, min(a, bins - a - 1) + 1):
            if bins - a - b <= b:
                found.append((a, b, bins - a - b))
    return found


def least_squares(columns: list[tuple[int, ...]], target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts of the combinations, by accelerated projected gradients.

    Too few pieces of small bins are cheap, as greedy packing fills gaps with them, so rows
    are weighted by the size of their bins.
    """
    bins = len(target)
    parts = np.array([list(c) + [0] * (DEPTH - len(c)) for c in columns])
    weight = np.sqrt(np.arange(bins, dtype=float) / bins)
    weight[0] = 0

    def times(x):
        return weight * np.bincount(parts.ravel(), np.repeat(x, DEPTH), bins)

    def back(r):
        return (weight * r)[parts].sum(1)

    goal = weight * target
    x = momentum = np.zeros(len(columns))
    probe = np.ones(len(columns))
    for _ in range(20):
        probe = back(times(probe))
        probe /= np.linalg.norm(probe)
    rate, t = 1 / (1.01 * np.linalg.norm(back(times(probe)))), 1.0
    for _ in range(rounds):
        new = np.maximum(0, momentum - rate * back(times(momentum) - goal))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def strategy(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of bins with their repeat counts; together they hold every piece.

    histogram[b]: pieces in bin b (b = 1 to the bins of a window). No bin is overdrawn.
    """
    bins = len(histogram) - 1
    columns = combinations(bins)
    left = histogram.astype(np.int64).copy()
    out = []

    def take(combo, times):
        if times > 0:
            out.append((combo, int(times)))
            for b in combo:
                left[b] -= times

    counts = np.floor(least_squares(columns, histogram.astype(float)) + 1e-6).astype(np.int64)
    for k in np.argsort(-counts, kind="stable"):
        if counts[k] <= 0:
            break
        combo = columns[k]
        need = {b: combo.count(b) for b in combo}
        take(combo, min(counts[k], *(left[b] // n for b, n in need.items())))
    # greedily: the largest rest, then the largest that fits, as often as the bins allow
    while left[1:].any():
        combo, room = [], bins
        while room:
            fits = [b for b in range(min(room, bins), 0, -1) if left[b] > combo.count(b)]
            if not fits:
                break
            combo.append(fits[0])
            room -= fits[0]
        take(tuple(combo), min(left[b] // combo.count(b) for b in combo))
    return out


def ranks(rows: DataFrame, key: str, order: list[str], label: str) -> DataFrame:
    """``rows`` (a written table) with ``rank`` from 0 within ``key``, whatever a key's size.

    Rows of a key are dealt to blocks by a hash, ranked within their block, and moved by the
    rows of the blocks before; a block, not a key, is what one task sorts.
    """
    blocks = rows.count() // RANK_ROWS + 1
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    sizes = dealt.groupBy(key, "deal").agg(F.count("*").alias("size"))
    before = Window.partitionBy(key).orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size"), label)
    within = Window.partitionBy(key, "deal").orderBy(*order)
    return (
        dealt.withColumn("turn", F.row_number().over(within))
        .join(offsets, [key, "deal"])
        .withColumn("rank", F.col("before") + F.col("turn") - 1)
        .drop("turn", "before", "deal")
    )


def pack(docs: DataFrame, path: str, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """One row per piece, with ``sequence_id`` and ``offset`` in its sequence.

    Pieces of a sequence follow each other without gaps from offset 0 and never exceed the
    window. Repeated rows are documents of their own. Other columns of ``docs`` are ignored;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = settle(pieces(docs, path, window).withColumn("bin", F.ceil(F.col("length") / step)), "pieces")
    bins = window // step
    histogram = np.zeros(bins + 1, np.int64)
    for row in cut.groupBy("bin").count().collect():  # at most window / step rows
        histogram[row["bin"]] = row["count"]
    used = np.zeros(bins + 1, np.int64)
    places, sequences = [], 0
    for combo, times in strategy(histogram):
        for turn, b in enumerate(combo):
            places.append((b, int(used[b]), int(used[b] + times), sequences, turn))
            used[b] += times
        sequences += times
    # a few rows per combination that occurs: bounded by the bins, not by the data
    table = spark.createDataFrame(places, "bin long, low long, high long, first long, turn int")
    ranked = ranks(cut, "bin", ["doc_id", "start", "ids_crc32", "length", "doc_tokens"], "bin-blocks")
    placed = ranked.join(
        F.broadcast(table), (ranked["bin"] == table["bin"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    ).withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low"))
    before = Window.partitionBy("sequence_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path())
