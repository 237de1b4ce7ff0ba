"""SimHash near-dedup by the generalised pigeonhole principle.

Equal fingerprints are collapsed first, so a group of copies is one row whatever its size.
The 64 bits are grouped into partitions so that correlated bits share one. A pair within
distance ``LINK`` is, in at least one partition, within that partition's threshold, for any
thresholds that add up to ``LINK - partitions + 1`` (-1 leaves a partition out). Each
fingerprint gets the thresholds with the fewest estimated candidates by dynamic programming
over the partitions, probes the values within them, and verifies what it meets.

A value that many fingerprints share would give all pairs among them. Its fingerprints are
linked exactly by another way: two fingerprints are within distance 2 if and only if they
share one of the 65 keys within distance 1 of each, so each sends its keys and is linked to
the smallest fingerprint of a key. That is linear in the group.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm.components import components
from skylattice.llm.text import documents, slices, whole, words_of
from skylattice.session import settle

BITS = 64
LINK = 2
SHINGLE = 3
PARTITIONS = 3
CROWD = 32  # a value shared by more fingerprints is linked by keys instead of pairs
SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes, repeats included."""
    words = words_of(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())
    hash_ = xxhash.xxh64_intdigest
    found = np.array([hash_(joined[a:b], SEED) for a, b in spans], "<u8")
    counts = np.zeros(BITS, np.int64)
    for begin in range(0, len(found), 16384):
        bits = np.unpackbits(found[begin : begin + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(found), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long; null texts count as empty."""

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _with_fingerprints(rows, "doc_id long", shingle)


def _with_fingerprints(rows: DataFrame, kept: str, shingle: int) -> DataFrame:
    """The columns before ``text``, described by ``kept``, and ``fp``; few texts are Python objects at a time."""
    names = rows.columns[:-1]

    def count(batches):
        for batch in slices(batches):
            found = [fingerprint(t or "", shingle) for t in batch.column("text").to_pylist()]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), fp], [*names, "fp"])

    return rows.mapInArrow(count, f"{kept}, fp long")


def partition_bits(distinct: DataFrame, partitions: int = PARTITIONS) -> list[list[int]]:
    """Groups of bits of nearly equal size; each takes up the bits most correlated with it.

    The 64 x 64 counts of bits set together are summed over all fingerprints.
    """

    def count(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(fp, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        if n:
            i, j = np.divmod(np.arange(BITS * BITS), BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(j), pa.array(total.ravel()), pa.array(np.full(BITS * BITS, n))],
                ["i", "j", "both", "n"],
            )

    sums = distinct.select("fp").mapInArrow(count, "i long, j long, both double, n long")
    rows = sums.groupBy("i", "j").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).toPandas()
    if not len(rows):
        return [list(range(k, BITS, partitions)) for k in range(partitions)]
    both = np.zeros((BITS, BITS))
    both[rows["i"], rows["j"]] = rows["both"] / rows["n"]
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    alike = np.abs((both - np.outer(mean, mean)) / np.outer(spread, spread))
    left, groups = set(range(BITS)), []
    for k in range(partitions):
        size = (BITS + k) // partitions
        rest = sorted(left)
        group = [max(rest, key=lambda b: (alike[b, rest].sum(), -b))]
        left -= set(group)
        while len(group) < size:
            best = max(sorted(left), key=lambda b: (alike[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _value(fp, bits: list[int]) -> F.Column:
    """The bits of one partition, as the fingerprint with all other bits cleared."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _flip(bit: int) -> int:
    return -(1 << 63) if bit == 63 else 1 << bit


def thresholds(cost: np.ndarray, total: int) -> np.ndarray:
    """The cheapest thresholds per row, by dynamic programming over partitions.

    cost: (rows, partitions, choices) for thresholds -1, 0, 1, ...; they add up to ``total``.
    """
    rows, parts, choices = cost.shape
    reach = total + parts  # sum of (threshold + 1)
    best = np.full((rows, reach + 1), np.inf)
    best[:, 0] = 0
    took = []
    for p in range(parts):
        step = np.full((rows, reach + 1, choices), np.inf)
        for c in range(choices):
            step[:, c:, c] = best[:, : reach + 1 - c] + cost[:, p, c][:, None]
        took.append(step.argmin(2))
        best = step.min(2)
    out, left = np.zeros((rows, parts), np.int64), np.full(rows, reach)
    for p in reversed(range(parts)):
        pick = took[p][np.arange(rows), left]
        out[:, p] = pick - 1
        left = left - pick
    return out


def links(distinct: DataFrame, partitions: int = PARTITIONS, crowd: int = CROWD) -> DataFrame:
    """``a, b``: links whose components are those of all pairs within distance ``LINK``.

    distinct: a written table with one row per fingerprint ``fp``.
    """
    spark = distinct.sparkSession
    groups = partition_bits(distinct, partitions)
    parts = F.array(*[F.struct(F.lit(k).alias("part"), _value(F.col("fp"), g).alias("value")) for k, g in enumerate(groups)])
    entries = distinct.select("fp", F.explode(parts).alias("e")).select("fp", "e.part", "e.value")
    sizes = settle(entries.groupBy("part", "value").agg(F.count("*").alias("size")), "simhash-sizes")

    # what a further differing bit adds is estimated from the share of values that are taken
    spans = sizes.groupBy("part").agg(F.sum("size").alias("n"), F.sum(F.col("size") * F.col("size")).alias("pairs"))
    found = {r["part"]: r["pairs"] / r["n"] for r in spans.collect()}  # one row per partition
    usual = np.array([found.get(k, 1.0) for k in range(partitions)])
    width = np.array([len(g) for g in groups])

    def choose(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            exact = np.stack([batch.column(f"s{k}").to_numpy() for k in range(partitions)], 1).astype(float)
            near = width * usual
            cost = np.stack([np.zeros_like(exact), exact, exact + near + width, exact + near * width / 2 + width**2 / 2], 2)
            cost = cost[:, :, : LINK + 2]
            picked = thresholds(cost, LINK - partitions + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp), *(pa.array(picked[:, k]) for k in range(partitions))],
                ["fp", *(f"t{k}" for k in range(partitions))],
            )

    measured = entries.join(sizes, ["part", "value"])
    wide = measured.groupBy("fp").agg(
        *[F.max(F.when(F.col("part") == k, F.col("size"))).alias(f"s{k}") for k in range(partitions)]
    )
    plan = settle(
        wide.mapInArrow(choose, "fp long, " + ", ".join(f"t{k} long" for k in range(partitions))),
        "simhash-thresholds",
    )

    def probed(k, bits):
        base = _value(F.col("fp"), bits)
        flips = [F.lit(_flip(b)) for b in bits]
        own = F.array(base)
        one = F.concat(own, F.array(*[base.bitwiseXOR(x) for x in flips]))
        two = F.concat(one, F.array(*[base.bitwiseXOR(F.lit(_flip(b) ^ _flip(c))) for i, b in enumerate(bits) for c in bits[:i]]))
        t = F.col(f"t{k}")
        values = F.when(t == 0, own).when(t == 1, one).when(t == 2, two).otherwise(F.array().cast("array<long>"))
        return F.transform(values, lambda v: F.struct(F.lit(k).alias("part"), v.alias("value")))

    probes = [probed(k, bits) for k, bits in enumerate(groups)]
    probe = plan.select("fp", F.explode(F.concat(*probes)).alias("p")).select(F.col("fp").alias("x"), "p.part", "p.value")

    few = sizes.where(F.col("size") <= crowd).select("part", "value")
    many = settle(sizes.where(F.col("size") > crowd).select("part", "value"), "simhash-crowds")
    index = entries.join(few, ["part", "value"], "left_semi").withColumnRenamed("fp", "y")
    pairs = (
        probe.join(index, ["part", "value"])
        .where((F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= LINK))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )
    # crowded values: those who probe them and those who hold them meet at keys within distance 1
    met = (
        probe.withColumnRenamed("x", "fp").unionByName(entries)
        .join(many, ["part", "value"], "left_semi")
        .select("fp").distinct()
    )
    keys = met.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_flip(b))) for b in range(BITS)])).alias("key"))
    hubs = keys.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    crowded = keys.join(hubs, "key").where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    return settle(pairs.unionByName(crowded).distinct(), "simhash-links")


def _classes(distinct: DataFrame) -> DataFrame:
    """``fp, root``: the smallest fingerprint that each of a written table's ``fp`` reaches."""
    labels = components(links(distinct))
    named = distinct.join(labels, distinct["fp"] == labels["node"], "left")
    return named.select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def near_dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per document.

    Fingerprints link at ``LINK`` or fewer differing bits; ``component_id`` is the smallest
    doc_id reachable, its own included. Documents without words have fingerprint zero and
    link like any other. Null ids are passed over when the smallest is taken; repeated rows
    share their component. Other columns are ignored; an empty table gives no rows.
    """
    found = settle(fingerprints(docs, shingle), "simhash")
    distinct = settle(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    named = _classes(distinct)
    roots = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.select("fp", "root").join(roots, "root").select("fp", "component_id")
    return found.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The documents without those that are near copies of a kept one, all columns kept.

    Of each component the row of the smallest doc_id stays, rows without an id behind all
    others, ties by a digest of the text. Rows of one id with unlike texts are of different
    components, so each stays or goes with its own. Of rows that repeat id and text one stays,
    whichever has the smallest hash of all its columns. A null text counts as an empty one.
    """
    late = F.lit((1 << 63) - 1)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.struct(F.coalesce(F.col("doc_id").cast("long"), late).alias("place"), F.unhex(F.md5(whole())).alias("form")).alias("key"),
    )
    found = _with_fingerprints(
        keyed.select("key.place", "key.form", whole("row.text").alias("text")), "place long, form binary", shingle
    )
    found = settle(found, "simhash")
    distinct = settle(found.groupBy("fp").agg(F.min(F.struct("place", "form")).alias("key")), "simhash-distinct")
    named = _classes(distinct).groupBy("root").agg(F.min("key").alias("key"))
    stay = settle(named.select("key"), "simhash-kept")
    left = keyed.join(stay, "key", "left_semi")
    return left.groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir))
