"""Line dedup by an exact set-similarity join with prefix, positional and length filters.

A line is the set of its words. A line that comes after a line of Jaccard similarity 0.8 or
more goes; lines are ordered by doc_id and then by their place in the document. Every
comparison is made on the input, so a removed line still counts as an earlier one.

1. Equal lines: each block of documents sends a hash of each different line once. A line that
   is not the first of its kind is a later match.
2. First lines send their prefix, the ``n - ceil(0.8 n) + 1`` words that come first in an
   order of rarity. Two similar lines share a word of their prefixes. The order is by the
   counts of all words in a fixed number of bins, then by hash: the result does not depend
   on it, only the number of lines that meet.
3. Lines that meet at a word pass the length filter, the positional filter, and a bound on
   their difference by the parity of their words' bits. A line proposes the first earlier
   one that is left of each word, and of these the one that most words agree on; so a group
   of near copies gives one proposal each and not all pairs.
4. Proposals are verified on the words themselves. A line that found no match and had more
   to propose proposes all of it in a second round, so nothing is missed.
"""

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.llm.text import block_count, blocked, borders, documents, mix, packed, unpacked, whole
from skylattice.session import settle

SIMILARITY = 0.8
BINS = 1 << 16  # bins of word counts
CHUNK = 1024  # bins summed in one row
BUCKET_BLOCKS = 2  # blocks whose words meet in one bucket, on average
NEVER = (1 << 63) - 1  # the place of null ids
LIMIT_N, LIMIT_I = (1 << 20) - 1, (1 << 12) - 1  # larger sizes and places pass the filters
COMPARED = 1_000_000  # comparisons made at once within a bucket
BASE = 0x9E3779B97F4A7C15 | 1  # of the words' polynomial hash
LONG_WORD = 256  # bytes from which on a word is hashed on its own
STRETCH = 1 << 18  # bytes whose words are hashed in one go
LONG_LINE = 64  # different words from which on a line sends 256 parities instead of 64

# kinds of rows that blocks send; GONE lines equal an earlier one, MATCHED are similar to one
LINES, OPEN, GONE, MATCHED = 0, 1, 2, 3
ROW = "bucket int, block int, kind int, data binary"
MARK = "block int, kind int, data binary"


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2^64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(STRETCH + LONG_WORD, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of UTF-8 text, and the line it is in, by prefix sums over the bytes."""
    if not data:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.frombuffer(data, np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    line = np.searchsorted(np.flatnonzero(codes == 10), start)
    forth, back = powers()
    h = np.empty(len(start), np.uint64)
    short = np.flatnonzero(end - start < LONG_WORD)
    for some in np.split(short, np.searchsorted(start[short], np.arange(STRETCH, len(codes), STRETCH))):
        if len(some):
            a, b = start[some[0]], end[some[-1]]
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum((codes[a:b] + np.uint64(1)) * forth[: b - a], out=sums[1:])
            h[some] = mix((sums[end[some] - a] - sums[start[some] - a]) * back[start[some] - a])
    for i in np.flatnonzero(end - start >= LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]])
    return h, line


class Lines:
    """The lines of a block's documents, numbered in the order of ids and texts."""

    def __init__(self, table: pa.Table):
        table = unpacked(table)
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        self.table = table
        self.rows = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.doc_ids = [ids[i] for i in self.rows]
        self.texts = [texts[i] for i in self.rows]
        self.data = "\n".join(self.texts).encode("utf-8", "surrogatepass")
        self.lines = self.data.split(b"\n")
        self.counts = [t.count("\n") + 1 for t in self.texts]

    def order(self) -> np.ndarray:
        order = np.array([NEVER if d is None else d for d in self.doc_ids], np.int64)
        return np.repeat(order, self.counts)

    def words(self, numbers: np.ndarray, weight=None) -> tuple[np.ndarray, np.ndarray]:
        return different_words([self.lines[i] for i in numbers], weight)


def different_words(lines: list[bytes], weight=None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different words of lines, sorted by weight and hash within a line, and
    how many each line has."""
    h, line = word_hashes(b"\n".join(lines))
    keys = (h, line) if weight is None else (h, weight[(h >> np.uint64(48)).astype(np.int64)], line)
    at = np.lexsort(keys)
    h, line = h[at], line[at]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    return h[first], np.bincount(line[first], minlength=len(lines))


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def rows_of(found: list[tuple]) -> pa.Table:
    columns = list(zip(*found)) or [[]] * 4
    return pa.table({
        name: pa.array(list(c), kind)
        for (name, kind), c in zip((("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())), columns)
    })


def columnar(*columns) -> bytes:
    """Columns of equal length one after the other, which compresses better than rows."""
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def parts(data: bytes, *dtypes) -> list[np.ndarray]:
    n = len(data) // sum(np.dtype(d).itemsize for d in dtypes)
    out, at = [], 0
    for d in map(np.dtype, dtypes):
        out.append(np.frombuffer(data, d, n, at))
        at += n * d.itemsize
    return out


def send_lines(block: int, lines: Lines, buckets: int) -> pa.Table:
    """Each different line with its first number, and the numbers of later equal ones.

    Lines without words take no part.
    """
    digests = [xxhash.xxh3_128_digest(line) if line.strip() else None for line in lines.lines]
    used = np.array([i for i, d in enumerate(digests) if d is not None], np.int64)
    keys = np.frombuffer(b"".join(d for d in digests if d is not None), ">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((used, keys[:, 1], keys[:, 0]))
    keys, numbers = keys[order], used[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]).any(1)
    out = [(block % buckets, block, GONE, np.sort(numbers[~first]).astype("<u4").tobytes())]
    keys, numbers = keys[first], numbers[first]
    at, places = borders(keys[:, 0], buckets), lines.order()
    for b in np.flatnonzero(np.diff(at)):
        s = slice(at[b], at[b + 1])
        out.append((int(b), block, LINES, columnar(keys[s, 0], keys[s, 1], places[numbers[s]], numbers[s].astype("<u4"))))
    return rows_of(out)


def meet_lines(table: pa.Table) -> pa.Table:
    """The lines of each block that are not the first of their kind."""
    out, sent = [], []
    for block, kind, data in zip(*(table.column(c).to_pylist() for c in ("block", "kind", "data"))):
        if kind == GONE:
            out.append((block, GONE, data))
        else:
            sent.append((block, *parts(data, "<u8", "<u8", "<i8", "<u4")))
    if sent:
        block = np.repeat([s[0] for s in sent], [len(s[1]) for s in sent])
        a, b, order, number = (np.concatenate([s[i] for s in sent]) for i in range(1, 5))
        at = np.lexsort((number, block, order, b, a))
        later = np.zeros(len(at), bool)
        later[1:] = (a[at][1:] == a[at][:-1]) & (b[at][1:] == b[at][:-1])
        gone = at[later]
        for one in np.unique(block[gone]):
            out.append((int(one), GONE, number[gone[block[gone] == one]].tobytes()))
    return control(out)


def control(found: list[tuple]) -> pa.Table:
    columns = list(zip(*found)) or [[]] * 3
    return pa.table({"block": pa.array(columns[0], pa.int32()), "kind": pa.array(columns[1], pa.int32()), "data": pa.array(columns[2], pa.binary())})


def word_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all words by bin, added up in tasks; the bins reach the driver once."""

    def count(batches):
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i in range(0, len(texts), 128):
                h, _ = word_hashes("\n".join(texts[i : i + 128]).encode("utf-8", "surrogatepass"))
                total += np.bincount((h >> np.uint64(48)).astype(np.int64), minlength=BINS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BINS // CHUNK), pa.int32()), pa.array([c.tobytes() for c in total.reshape(-1, CHUNK)], pa.binary())],
            ["chunk", "data"],
        )

    def join(key, table):
        total = sum(np.frombuffer(d, "<i8") for d in table.column("data").to_pylist())
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    rows = docs.select(whole().alias("text")).mapInArrow(count, "chunk int, data binary")
    total = np.zeros((BINS // CHUNK, CHUNK), np.int64)
    for row in rows.groupBy("chunk").applyInArrow(join, "chunk int, data binary").collect():
        total[row["chunk"]] = np.frombuffer(row["data"], "<i8")
    return total.ravel()


def numbers_of(table: pa.Table, kind: int) -> np.ndarray:
    """The line numbers a control table lists."""
    found = [np.frombuffer(d, "<u4") for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()) if k == kind]
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.empty(0, np.int64)


def send_prefixes(block: int, lines: Lines, gone: np.ndarray, again, weight, buckets: int) -> pa.Table:
    """Prefix words of the lines that stand, packed by hash range.

    ``again``: the lines that propose in a second round, or None in the first.
    """
    stand = np.array([bool(line.strip()) for line in lines.lines], bool)
    stand[gone] = False
    numbers = np.flatnonzero(stand)
    if not len(numbers):
        return rows_of([])
    h, sizes = lines.words(numbers, weight)
    starts = starts_of(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(h)) - starts[owner]
    mixed = mix(h)
    bit = np.uint64(1) << (mixed >> np.uint64(58))
    lane = (mixed >> np.uint64(56)) & np.uint64(3)
    # parities of all words, and of those of three of four lanes
    sketch = np.bitwise_xor.reduceat(bit, starts)
    lanes = [np.bitwise_xor.reduceat(np.where(lane == k, bit, np.uint64(0)), starts) for k in range(3)]
    length = sizes - np.ceil(SIMILARITY * sizes - 1e-9).astype(np.int64) + 1
    pick = np.flatnonzero(place < length[owner])
    pick = pick[np.argsort(h[pick])]
    word, owner, place = h[pick], owner[pick], place[pick]
    number = numbers[owner]
    asks = np.full(len(lines.lines), again is None)
    if again is not None:
        asks[again] = True
    tag = (number | (asks[number].astype(np.int64) << 31)).astype("<u4")
    form = (np.minimum(sizes[owner], LIMIT_N) << 12 | np.minimum(place, LIMIT_I)).astype("<u4")
    order, low, long_ = lines.order()[number], word.astype("<u4"), sizes[owner] >= LONG_LINE
    at, out = borders(word, buckets), []
    for b in np.flatnonzero(np.diff(at)):
        s = slice(at[b], at[b + 1])
        more = owner[s][long_[s]]
        head = np.array([at[b + 1] - at[b]], "<i8")
        data = columnar(head, low[s], order[s], tag[s], form[s], sketch[owner[s]], *(x[more] for x in lanes))
        out.append((int(b), block, LINES, data))
    return rows_of(out)


def entries_of(data: bytes) -> tuple:
    """The columns that ``send_prefixes`` packed, and the lanes of the long lines among them."""
    n = int(np.frombuffer(data, "<i8", 1)[0])
    end = 8 + 28 * n
    columns = parts(data[8:end], "<u4", "<i8", "<u4", "<u4", "<u8")
    return *columns, np.frombuffer(data, "<u8", -1, end).reshape(3, -1)


def propose(table: pa.Table, all_: bool) -> pa.Table:
    """Pairs of lines that pass the filters, sent to the later one's block.

    A line proposes the first earlier one of each word, and marks whether there are more; or
    ``all_`` of them.
    """
    sent = [(b, *entries_of(d)) for b, d in zip(table.column("block").to_pylist(), table.column("data").to_pylist())]
    block = np.repeat(np.array([s[0] for s in sent], np.int64), [len(s[1]) for s in sent])
    word, order, tag, form, sketch = (np.concatenate([s[i] for s in sent]) for i in range(1, 6))
    long_ = np.flatnonzero(form >> 12 >= LONG_LINE)
    lanes = np.concatenate([s[6] for s in sent], 1)
    lane_of = np.zeros(len(word), np.int64)
    lane_of[long_] = np.arange(len(long_))
    # words of one line are left out before anything is ordered
    at = np.argsort(word)
    same = word[at][1:] == word[at][:-1]
    at = at[np.append(same, False) | np.insert(same, 0, False)] if len(at) > 1 else at[:0]
    block, word, order, tag, form, sketch, lane_of = (x[at] for x in (block, word, order, tag, form, sketch, lane_of))
    number = (tag & np.uint32(0x7FFFFFFF)).astype(np.int64)
    at = np.lexsort((number, block, order, word))
    block, number, sketch, form, word, lane_of = (x[at] for x in (block, number, sketch, form, word, lane_of))
    n, place, asks = (form >> 12).astype(np.int64), (form & LIMIT_I).astype(np.int64), tag[at] >> 31 == 1
    begin = np.flatnonzero(np.insert(word[1:] != word[:-1], 0, True)) if len(word) else np.empty(0, np.int64)
    size = np.diff(np.append(begin, len(word)))
    start = np.repeat(begin, size)
    rank = np.arange(len(word)) - start
    # two lines differ in at most (1 - s) / (1 + s) of the sum of their sizes
    slack = np.where(n >= LIMIT_N, 64, (1 - SIMILARITY) / (1 + SIMILARITY) * n + 0.01).astype(np.float32)

    def near(a, b):
        both, least, most = n[a] + n[b], np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        need = np.ceil(SIMILARITY / (1 + SIMILARITY) * both - 1e-9)
        fit = (least >= SIMILARITY * most - 1e-9) & (np.minimum(n[a] - place[a], n[b] - place[b]) >= need)
        deep = np.flatnonzero(fit & (least >= LONG_LINE))
        x, y = a[deep], b[deep]
        differ = lanes[:, lane_of[x]] ^ lanes[:, lane_of[y]]
        rest = sketch[x] ^ sketch[y] ^ differ[0] ^ differ[1] ^ differ[2]
        far = np.bitwise_count(differ).sum(0, dtype=np.int64) + np.bitwise_count(rest)
        fit[deep] = far <= both[deep] - 2 * need[deep]
        return fit | (most >= LIMIT_N)

    live, chosen = np.flatnonzero((rank > 0) & asks), np.full(len(word), -1)
    more, pairs, j = np.zeros(len(word), bool), [], 0
    while len(live):
        span = max(1, min(64, COMPARED // len(live))) if j > 2 else 1
        offset = np.arange(j, j + span)
        b = np.minimum(start[live][:, None] + offset, live[:, None] - 1)
        # the parities rule out nearly all; the other filters look at the rest
        fits = np.bitwise_count(sketch[live][:, None] ^ sketch[b]) <= slack[live][:, None] + slack[b]
        fits &= offset < rank[live][:, None]
        row, column = np.nonzero(fits)
        fits[row, column] = near(live[row], b[row, column])
        if all_:
            row, column = np.nonzero(fits)
            pairs.append((live[row], b[row, column]))
        else:
            count = fits.sum(1) + (chosen[live] >= 0)
            new = (chosen[live] < 0) & fits.any(1)
            hit = live[new]
            chosen[hit] = start[hit] + j + fits[new].argmax(1)
            more[live[count > 1]] = True
        j += span
        live = live[(rank[live] > j) & ~more[live]]
    if not all_:
        hit = np.flatnonzero(chosen >= 0)
        pairs = [(hit, chosen[hit])]
    if not pairs:
        return routed(np.empty((0, 5), np.int64))
    a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    pairs, votes = np.unique(np.stack([block[a], number[a], block[b], number[b], more[a]], 1), axis=0, return_counts=True)
    return routed(np.column_stack([pairs, votes]))


def choose(key, table: pa.Table, all_: bool) -> pa.Table:
    """Pairs sent to the earlier line's block: of each line's proposals the one that most
    words made, with a mark if there are others; or ``all_`` of them."""
    pairs = np.concatenate([np.frombuffer(d, "<i8").reshape(-1, 5) for d in table.column("data").to_pylist()])
    number, to_block, to_number, more, votes = pairs.T
    if not all_:
        order = np.lexsort((to_number, to_block, number))
        pairs = pairs[order]
        new = np.insert((pairs[1:, :3] != pairs[:-1, :3]).any(1), 0, True)
        first = np.flatnonzero(new)
        number, to_block, to_number = pairs[first, :3].T
        more, votes = np.maximum.reduceat(pairs[:, 3], first), np.add.reduceat(pairs[:, 4], first)
        order = np.lexsort((-votes, number))
        number, to_block, to_number, more = (x[order] for x in (number, to_block, to_number, more))
        first = np.flatnonzero(np.insert(number[1:] != number[:-1], 0, True))
        count = np.diff(np.append(first, len(number)))
        more = np.maximum(np.maximum.reduceat(more, first), count > 1)
        number, to_block, to_number = number[first], to_block[first], to_number[first]
    rows = np.stack([to_block, to_number, np.full(len(number), key[0].as_py()), number, more], 1)
    return routed(np.unique(rows, axis=0))


def routed(pairs: np.ndarray) -> pa.Table:
    """Rows by the block in their first column, packed without it."""
    blocks, at = np.unique(pairs[:, 0], return_index=True)
    ends = np.append(at[1:], len(pairs))
    return pa.table({
        "block": pa.array(blocks.astype(np.int32)),
        "data": pa.array([pairs[a:b, 1:].astype("<i8").tobytes() for a, b in zip(at, ends)], pa.binary()),
    })


def send_words(texts: pa.Table, asked: pa.Table) -> pa.Table:
    """Answers proposals with the earlier line, sent to the later one's block."""
    if not asked.num_rows or not texts.num_rows:
        return control([])
    pairs = np.unique(np.concatenate([np.frombuffer(d, "<i8").reshape(-1, 4) for d in asked.column("data").to_pylist()]), axis=0)
    lines, out = Lines(texts), []
    pairs = pairs[np.argsort(pairs[:, 1], kind="stable")]
    squeeze = zstandard.ZstdCompressor(level=3)
    for some in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 1])) + 1):
        used, local = np.unique(some[:, 0], return_inverse=True)
        text = squeeze.compress(b"\n".join([lines.lines[i] for i in used]))
        head = np.array([len(some)], "<i8")
        out.append((int(some[0, 1]), 0, columnar(head, some[:, 2], some[:, 3], local) + text))
    return control(out)


def verify(key, texts: pa.Table, answers: pa.Table) -> pa.Table:
    """``block, kind, data``: which lines of the block have an earlier match (MATCHED), and
    which have none so far but more to propose (OPEN)."""
    if not answers.num_rows or not texts.num_rows:
        return control([])
    lines = Lines(texts)
    matched, more = set(), set()
    mine: dict[int, np.ndarray] = {}
    asked, others = [], []
    for data in answers.column("data").to_pylist():
        k = int(np.frombuffer(data, "<i8", 1)[0])
        asked.append(np.frombuffer(data, "<i8", 3 * k, 8).reshape(3, k) + np.array([[0], [0], [len(others)]]))
        others += zstandard.decompress(data[8 + 24 * k :]).split(b"\n")
    number, flag, local = np.concatenate(asked, 1)
    wanted = np.unique(number)
    h, counts = lines.words(wanted)
    begins = starts_of(counts)
    for i, line in enumerate(wanted):
        mine[int(line)] = h[begins[i] : begins[i] + counts[i]]
    words, sizes = different_words(others)
    begin = starts_of(sizes)
    for a, extra, b in zip(number.tolist(), flag.tolist(), local.tolist()):
        if extra:
            more.add(a)
        if a in matched:
            continue
        own, other = mine[a], words[begin[b] : begin[b] + sizes[b]]
        common = int((own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other).sum())
        if common >= SIMILARITY * (len(own) + len(other) - common) - 1e-9:
            matched.add(a)
    block = key[0].as_py()
    marks = [(MATCHED, matched), (OPEN, more - matched)]
    return control([(block, kind, np.array(sorted(s), "<u4").tobytes()) for kind, s in marks if s])


def line_dedup(docs: DataFrame, blocks: int | None = None, rest: bool = False) -> DataFrame:
    """``doc_id, text, n_lines, n_removed`` per document: the text without removed lines.

    With ``rest``, the other columns of ``docs`` come along in a struct of that name.

    Lines without words stay. A null id comes after all others, and of rows with equal ids
    the smaller text within a block comes first. A null text is one empty line. Rows that
    repeat an id and text are copies like any other: the first one stays. Other columns are
    ignored; an empty table gives no rows.
    """
    blocks = blocks or block_count(docs)
    buckets = blocks // BUCKET_BLOCKS + 1
    dealt = blocked(docs, blocks, rest)
    by_block = packed(dealt).groupBy("block")
    weight = word_counts(docs)
    sent = by_block.applyInArrow(lambda key, t: send_lines(key[0].as_py(), Lines(t), buckets), ROW)
    gone = sent.groupBy("bucket").applyInArrow(meet_lines, MARK)

    def round_(marks: DataFrame, all_: bool) -> DataFrame:
        def prefixes(key, texts, marks):
            if not texts.num_rows:
                return rows_of([])
            again = numbers_of(marks, OPEN) if all_ else None
            return send_prefixes(key[0].as_py(), Lines(texts), numbers_of(marks, GONE), again, weight, buckets)

        entries = by_block.cogroup(marks.groupBy("block")).applyInArrow(prefixes, ROW)
        proposed = entries.groupBy("bucket").applyInArrow(lambda t: propose(t, all_), "block int, data binary")
        pairs = proposed.groupBy("block").applyInArrow(lambda key, t: choose(key, t, all_), "block int, data binary")
        answers = by_block.cogroup(pairs.groupBy("block")).applyInArrow(send_words, MARK)
        return by_block.cogroup(answers.groupBy("block")).applyInArrow(verify, MARK)

    marks = settle(gone.unionByName(round_(gone, False)), "line-marks")
    if not marks.where(F.col("kind") == OPEN).isEmpty():
        marks = marks.where(F.col("kind") != OPEN).unionByName(settle(round_(marks, True), "line-marks"))

    def cut(texts, marks):
        lines = Lines(texts)
        out = {i for kind in (GONE, MATCHED) for i in numbers_of(marks, kind).tolist()}
        kept, removed, at = [], [], 0
        for text, n in zip(lines.texts, lines.counts):
            stay = [i for i in range(at, at + n) if i not in out]
            at += n
            removed.append(n - len(stay))
            kept.append(text if len(stay) == n else b"\n".join([lines.lines[i] for i in stay]).decode("utf-8", "surrogatepass"))
        out = {
            "doc_id": pa.array(lines.doc_ids, pa.int64()),
            "text": pa.array(kept, pa.string()),
            "n_lines": pa.array(lines.counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
        return pa.table(out | ({"rest": lines.table.column("rest").take(pa.array(lines.rows, pa.int64()))} if rest else {}))

    schema = T.StructType.fromDDL("doc_id long, text string, n_lines long, n_removed long")
    if rest:
        schema.add(dealt.schema["rest"])
    return by_block.cogroup(marks.groupBy("block")).applyInArrow(cut, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


SQL = rf"""
with l as (
  select doc_id, i, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) as ws, line
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)),
o as (select *, row_number() over (order by doc_id, i) as seat from l),
s as (select ws, min(seat) as first, len(ws) as n from o where len(ws) > 0 group by ws),
w as (select first, n, unnest(ws) as word from s),
m as (select distinct later from (
  select a.first as later, a.n + b.n as total, count(*) as common
  from w a join w b on a.word = b.word and b.first < a.first and least(a.n, b.n) >= {SIMILARITY} * greatest(a.n, b.n)
  group by a.first, b.first, a.n, b.n) where common >= {SIMILARITY} * (total - common)),
k as (select o.doc_id, o.i, o.line, s.first is not null and (o.seat > s.first or s.first in (select later from m)) as gone
      from o left join s on o.ws = s.ws)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from k group by doc_id
"""
