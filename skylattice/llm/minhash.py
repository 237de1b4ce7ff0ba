"""MinHash near-dedup with sequential Bayesian verification.

1. A document's set of shingles has a digest and a signature of ``BANDS * ROWS`` minimum
   hashes. Equal sets are one node, so a group of copies is one row.
2. Candidates share one of ``BANDS`` keys of ``ROWS`` minimum hashes each; a pair of similarity
   s shares none with probability ``(1 - s^ROWS)^BANDS``, 7 in a thousand million at 0.85.
3. Signatures are compared a batch of hashes at a time. With an even prior, similarity after m
   equal hashes of k has a Beta(m + 1, k - m + 1) posterior; a pair is pruned as soon as the
   probability that it reaches the threshold is below ``MISS``.
4. Survivors are compared exactly, on their whole texts.

Only pairs that could join two components are compared. The nodes of a key first meet its
smallest node, and what that links is one component. The nodes of keys that still hold several
components go on. Each counts its shingles that other components hold as well; it can share no
more with any of them, which leaves out most near copies whose changes are their own. The rest
are compared by what sets them apart from the smallest node of their key: two sets differ in
the shingles in which their differences from a third differ. Sets of n and m shingles that link
differ in at most t = (n + m) * 15 / 185, so with the rarest differences first, the first one
that they share comes after at most t that they do not. Only nodes that share such a difference
meet; what nearly all have in common is in no difference, so a crowd of sets just under the
threshold that changed at places of their own makes no pairs. They meet in rounds: a node's
level is drawn from its digest, a sixteenth of the nodes of a level being one higher, and round
by round the nodes of the next lower level meet those that share a difference, are in another
component and whose counts allow the similarity. So a group of near copies costs a comparison
each, and at the end every pair of different components has been compared or ruled out. Nodes
just under the threshold that share their changes cost the comparison of their pairs, spread
over the rounds and, by the join, over tasks.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm.components import components
from skylattice.llm.langid import chunks
from skylattice.llm.lines import word_hashes
from skylattice.llm.text import documents, mix, whole, window_hashes
from skylattice.session import settle

SIMILARITY = 85  # per cent
SHINGLE = 5
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32  # hashes compared at a time
MISS = 1e-9  # probability at which a pair is given up
BITMAP = 24  # bits of a hash that the bitmap of needed texts looks at
SLICE = 64  # rows of a batch that are Python objects at a time

_draws = np.random.default_rng(13)
FLIPS = _draws.integers(0, 1 << 32, HASHES, np.uint32)
FACTORS = _draws.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The different shingles' hashes of each text, in order; A-Z count as a-z.

    A text of fewer than ``SHINGLE`` words is one shingle, a text without words has none.
    """
    data = [t.encode("utf-8", "surrogatepass").lower().replace(b"\n", b" ") for t in texts]
    h, owner = word_hashes(b"\n".join(data))
    sizes = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(sizes) - sizes
    long_ = window_hashes(h, SHINGLE)
    out = []
    for a, n in zip(begin.tolist(), sizes.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(long_[a : a + n - SHINGLE + 1]))
        else:
            out.append(window_hashes(h[a : a + n], n) if n else np.empty(0, np.uint64))
    return out


def signature(found: np.ndarray) -> np.ndarray:
    """The minimum of each hash over a set that is not empty."""
    narrow, out = (mix(found) >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(narrow), 8192):
        some = narrow[at : at + 8192]
        np.minimum(out, ((some[None, :] ^ FLIPS[:, None]) * FACTORS[:, None]).min(1), out=out)
    return out


def _form(text) -> Column:
    """What names a text."""
    return F.unhex(F.md5(text))


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, form, place, node, n, sig``: digest and hash of the text, digest and size of the set,
    signature.

    ``node`` and ``sig`` are null for a text that is null or without words.
    """

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                nodes, sizes, signatures = [], [], []
                for _, some in chunks(enumerate(column.slice(at, SLICE).to_pylist())):
                    for found in shingle_sets(some):
                        sizes.append(len(found))
                        nodes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                        signatures.append(signature(found).tobytes() if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "form", "place")), pa.array(nodes, pa.binary()),
                        pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()),
                    ],
                    ["doc_id", "form", "place", "node", "n", "sig"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _form(whole()).alias("form"), F.xxhash64(whole()).alias("place"), whole().alias("text"))
    return rows.mapInArrow(run, "doc_id long, form binary, place long, node binary, n long, sig binary")


def least_matches(similarity: float = SIMILARITY / 100, miss: float = MISS, batch: int = BATCH) -> list[int]:
    """After each batch, the fewest equal hashes with which a pair goes on.

    P(s >= t | m of k) under an even prior is the probability that k + 1 throws of chance t
    succeed m times or less.
    """
    out = []
    for k in range(batch, HASHES + 1, batch):
        sum_, m = 0.0, 0
        while True:
            sum_ += math.comb(k + 1, m) * similarity**m * (1 - similarity) ** (k + 1 - m)
            if sum_ >= miss:
                break
            m += 1
        out.append(m)
    return out


def _survivors(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that no batch of their signatures gives up."""
    of = nodes.select("node", "sig")
    both = pairs.join(of.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a")
    both = both.join(of.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b").select("a", "b", "x", "y")
    least = least_matches()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("x", "y")
            )
            left, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for k, m in enumerate(least):
                at = slice(k * BATCH, (k + 1) * BATCH)
                equal = equal + (x[left, at] == y[left, at]).sum(1)
                left, equal = left[equal >= m], equal[equal >= m]
            yield batch.select(["a", "b"]).take(pa.array(left))

    return both.mapInArrow(run, "a binary, b binary")


def _sets(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, hashes``: the shingles' hashes, in order, of some ``node, form, place``.

    Only their texts move: a bitmap picks the rows to join, some too many and none too few. It
    has 2^BITMAP bits, in rows of 64, whatever the number of nodes, so it is broadcast.
    """
    at = F.shiftrightunsigned("place", 64 - BITMAP + 6)
    bit = F.shiftrightunsigned("place", 64 - BITMAP).bitwiseAND(F.lit(63)).cast("int").alias("bit")
    marks = nodes.select(at.alias("at"), bit).groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    picked = texts.select("text", at.alias("at"), bit).join(F.broadcast(marks), "at")
    picked = picked.where(F.expr("shiftrightunsigned(bits, bit) & 1 = 1")).select(_form(F.col("text")).alias("form"), "text")
    named = nodes.select("node", "form")
    found = picked.join(named, "form").groupBy("node").agg(F.first("text").alias("text"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                hashes = [x.tobytes() for x in shingle_sets(some.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([some.column("node"), pa.array(hashes, pa.binary())], ["node", "hashes"])

    return settle(found.mapInArrow(run, "node binary, hashes binary"), "minhash-sets")


def similar(a: np.ndarray, b: np.ndarray, similarity: int = SIMILARITY) -> bool:
    """Whether two sets, as sorted arrays that are not empty, reach the similarity."""
    if 100 * min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * common >= similarity * (len(a) + len(b) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets reach the similarity."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                rows = zip(some.column("x").to_pylist(), some.column("y").to_pylist())
                hit = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity) for x, y in rows]
                yield some.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def _common_at_most(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, most``: how many of a node's shingles are in other components' nodes as well.

    members: ``node, root``. No pair of nodes of different components shares more, now or when
    components have grown.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                for node, root, x in zip(*(some.column(c).to_pylist() for c in ("node", "root", "hashes"))):
                    x = np.frombuffer(x, np.int64)
                    ends = [pa.array([v] * len(x), pa.binary()) for v in (node, root)]
                    yield pa.RecordBatch.from_arrays([pa.array(x), *ends], ["shingle", "node", "root"])

    held = members.join(sets, "node").mapInArrow(run, "shingle long, node binary, root binary")
    wide = held.groupBy("shingle").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p != q").select("shingle")
    return held.join(wide, "shingle").groupBy("node").agg(F.count("*").alias("most"))


def _differences(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """``head, node, d, i, element``: the first differences of a node's set from that of a head.

    pairs: ``head, node, n``. Of the ``d`` differences, those that no other node has from this head
    come first, then the rarest; ``i`` is the place, from 0. No set that links differs in more
    than n * (100 - similarity) / similarity shingles, so differences after as many are left out.
    The last one, at place d, is the same for all, so that nodes with few differences meet.
    """
    both = pairs.join(sets.select(F.col("node").alias("head"), F.col("hashes").alias("x")), "head")
    both = both.join(sets.select("node", F.col("hashes").alias("y")), "node").select("head", "node", "n", "x", "y")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                apart = [
                    np.setxor1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), True)
                    for x, y in zip(some.column("x").to_pylist(), some.column("y").to_pylist())
                ]
                found = [pa.array(apart, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("head", "node", "n")), *found], ["head", "node", "n", "apart"])

    apart = settle(both.mapInArrow(run, "head binary, node binary, n long, apart array<long>"), "minhash-apart")
    rows = apart.select("head", "node", "n", F.size("apart").alias("d"), F.explode("apart").alias("element"))
    often = rows.groupBy("head", "element").agg(F.count("*").alias("often")).where("often > 1")
    shared = rows.join(often, ["head", "element"]).groupBy("head", "node", "n", "d")
    shared = shared.agg(F.array_sort(F.collect_list(F.struct("often", "element"))).alias("e"))
    shared = shared.select("head", "node", "n", "d", (F.col("d") - F.size("e")).alias("own"), F.posexplode("e").alias("at", "e"))
    shared = shared.select("head", "node", "n", "d", (F.col("own") + F.col("at")).alias("i"), "e.element")
    last = apart.select("head", "node", "n", F.size("apart").alias("d"), F.size("apart").alias("i"), F.lit(0).cast("long").alias("element"))
    both = shared.unionByName(last).where(f"{similarity} * i <= {100 - similarity} * n")
    return both.select("head", "node", "d", "i", "element")


def links(nodes: DataFrame, texts: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``a, b``: links whose components are those of all pairs of that similarity.

    nodes: a written table ``node, form, place, n, sig`` with a row per set.
    """
    size = 4 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * size + 1, size)) for k in range(BANDS)])
    entries = nodes.select("node", "n", F.explode(keys).alias("key"))
    heads = entries.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1")
    entries = settle(entries.join(heads, "key").select("key", "node", "n", "head", "size"), "minhash-entries")

    def candidates(pairs):
        found = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        return settle(_survivors(found, nodes), "minhash-candidates")

    def named(some):
        return nodes.join(some, "node", "left_semi").select("node", "form", "place")

    # all nodes of a key with its smallest one
    sizes = entries.where("node = head").select("key", F.col("n").alias("m"))
    first = entries.where("node != head").join(sizes, "key").where(f"100 * least(n, m) >= {similarity} * greatest(n, m)")
    found = candidates(first.select(F.col("head").alias("x"), F.col("node").alias("y")))
    ends = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = settle(_confirmed(found, _sets(named(ends), texts), similarity), "minhash-links")
    root = components(found)

    def open_keys(rows, *by):
        apart = rows.groupBy(*by).agg(F.min("root").alias("p"), F.max("root").alias("q"), F.count("*").alias("size"))
        return apart.where("p != q").select(*by, "size")

    # keys of three nodes or more that still hold several components
    rest = entries.where("size > 2").join(root, "node", "left").select("key", "head", "node", "n", F.coalesce("root", "node").alias("root"))
    rest = settle(rest.join(open_keys(rest, "key").select("key"), "key"), "minhash-open")
    if rest.isEmpty():
        return found
    members = settle(rest.select("node", "root").distinct(), "minhash-members")
    sets = _sets(named(members), texts)
    # a node that shares too little with all others together is out
    rest = rest.join(_common_at_most(members, sets), "node").where(f"100 * most >= {similarity} * n")
    rest = settle(rest, "minhash-rest")
    rest = rest.join(open_keys(rest, "key").select("key"), "key").select("head", "node", "n", "root", "most").distinct()
    # a node's level: how many zeros its digest begins with
    level = F.length(F.regexp_extract(F.hex("node"), "^0*", 0))
    rest = settle(rest.withColumn("level", level), "minhash-rest")
    rest = rest.join(_differences(rest.select("head", "node", "n"), sets, similarity), ["head", "node"])
    rest = settle(rest, "minhash-differences")
    by = ["head", "element"]
    open_ = settle(open_keys(rest, *by), "minhash-open")
    rest = settle(rest.join(open_.select(*by), by), "minhash-meeting")
    crowd = open_.agg(F.max("size")).first()[0]
    top = math.ceil(math.log(crowd, 16)) if crowd else -1
    for step in range(top, -1, -1):
        known = rest.drop("root").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        reached = F.least("level", F.lit(top))
        hubs = known.where(reached == step).select(
            *by, F.col("node").alias("x"), F.col("n").alias("m"), F.col("root").alias("hub"), F.col("most").alias("common"),
            F.col("d").alias("e"), F.col("i").alias("j"),
        )
        others = known.where(reached <= step).withColumn("lower", reached < step)
        shared = "least(most, common)"
        differ = "(i + j + abs((d - i) - (e - j)))"  # in so many at least, if no earlier one is shared
        pairs = hubs.join(others, by).where(
            f"root != hub and (lower or node < x) and 100 * {shared} >= {similarity} * (n + m - {shared})"
            f" and {100 + similarity} * {differ} <= {100 - similarity} * (n + m)"
        )
        new = candidates(pairs.select("x", F.col("node").alias("y")))
        if not new.isEmpty():
            found = settle(found.unionByName(_confirmed(new, sets, similarity)), "minhash-links")
            root = components(found)
    return found


def near_dedup(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document.

    Sets link at ``similarity`` per cent or more; component_id is the smallest doc_id reachable,
    its own included, and kept tells whether it is its own. A null text, or one without words,
    has the empty set and links with nothing. Null ids are passed over when the smallest is
    taken: a component without any id has a null component_id and is kept. Repeated rows share
    their component. Other columns are ignored; an empty table gives no rows.
    """
    found = settle(sketches(docs), "minhash-sketches")
    nodes = found.where("node is not null").groupBy("node").agg(
        F.max("n").alias("n"), F.max(F.struct("form", "place")).alias("text"), F.max("sig").alias("sig"), F.min("doc_id").alias("first")
    )
    nodes = settle(nodes.select("node", "n", "text.form", "text.place", "sig", "first"), "minhash-nodes")
    texts = docs.select(F.xxhash64(whole()).alias("place"), whole().alias("text"))
    root = components(links(nodes, texts, similarity))
    named = nodes.select("node", "first").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = settle(named, "minhash-roots")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.select("node", "root").join(least, "root").select("node", "component_id")
    out = found.select("doc_id", "n", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir))


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, shingle from (
    select doc_id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
                               else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as shingle
    from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
meeting as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id != b.doc_id group by all),
links as materialized (
  select a, b from meeting join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
reach(doc_id, other) as (
  select doc_id, doc_id from n union select r.doc_id, l.b from reach r join links l on l.a = r.other),
least_ as (select doc_id, min(other) as component_id from reach group by doc_id)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(l.component_id, w.doc_id) as component_id,
       coalesce(l.component_id, w.doc_id) = w.doc_id as kept
from w left join n on n.doc_id = w.doc_id left join least_ l on l.doc_id = w.doc_id
"""
