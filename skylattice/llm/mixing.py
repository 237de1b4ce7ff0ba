"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The words of a source, its documents in hash order, form one sequence that is cut into
blocks of equal size. A source's target is a number of block draws: whole passes over its
blocks and a part of a last pass. The draws of all sources are shared among output shards by
a binary tree: at each node the left half takes a multivariate-hypergeometric share of the
block quotas, so every shard is a uniform sample of the whole and quotas stay exact. Shards
then take consecutive draws of each source's permuted blocks, which are disjoint within a
pass, and order their own blocks by hash.

Only sources, tree nodes and blocks are moved, never texts. Sums along a source run over
hash buckets of bounded size, so a source with a third of all rows is many tasks' work.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.llm.text import WORD, documents, whole
from skylattice.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words of the mix, as a multiple of the words there are
CAP = 2  # most passes over a source
BLOCK_WORDS = 2048
LEAST_BLOCKS = 4096  # a small source has shorter blocks, so that its target is met closely
SHARD_BLOCKS = 4096
BUCKET_ROWS = 4_000
#: Strides of the two passes' permutations, primes above any number of blocks. Their parts of
#: a power of two are near 0.61 and 0.65, so that draws spread evenly.
STRIDES = (2654435761, 2246822519)
SEED = 17


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, place, form``: words per document, and its place by hash."""
    text = whole()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit("mix|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("place"),
        F.xxhash64(text).alias("form"),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sid, source, source_size, target, blocks, quota`` per source.

    Weights repeat along the sources in code-point order, null last. Sorted by how soon
    they fill up, the sources that reach their cap are the first ones; the rest share what
    is left by weight. One row per source, so the windows here are small.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    everything = Window.partitionBy()
    before = Window.orderBy("fills", "sid").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sources.withColumn("sid", (turn - 1).cast("long"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("most", F.col("source_size") * cap)
        .withColumn("fills", F.col("most") / F.col("weight"))
        .withColumn("rest", share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("heft", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("turn", F.row_number().over(Window.orderBy("fills", "sid")))
    )
    fits = F.col("rest") * F.col("weight") <= F.col("most") * F.col("heft")
    rows = rows.withColumn("open", F.min(F.when(fits, F.struct("turn", "rest", "heft"))).over(everything))
    target = F.when(
        F.col("open").isNull() | (F.col("turn") < F.col("open.turn")), F.col("most").cast("double")
    ).otherwise(F.col("open.rest") * F.col("weight") / F.col("open.heft"))
    blocks = F.greatest(
        F.ceil(F.col("source_size") / BLOCK_WORDS), F.least(F.col("source_size"), F.lit(LEAST_BLOCKS))
    )
    rows = rows.withColumn("target", target).withColumn("blocks", blocks)
    quota = F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5))
    return rows.select(
        "sid", "source", "source_size", "target", "blocks", F.coalesce(quota, F.lit(0)).cast("long").alias("quota")
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, chance: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are marked, by inversion of ``chance``.

    The probabilities follow from each other by their ratio. Counts more than twelve
    deviations from the mean, which weigh less than a double can tell, are left out.
    """
    part = marked / F.greatest(total, F.lit(1))
    mean = drawn * part
    spread = 12 * F.sqrt(mean * (1 - part) * (total - drawn) / F.greatest(total - 1, F.lit(1))) + 12
    least = F.greatest(F.lit(0), drawn - (total - marked), F.floor(mean - spread)).cast("long")
    most = F.least(marked, drawn, F.ceil(mean + spread)).cast("long")
    counts = F.sequence(least, F.greatest(least, most), F.lit(1).cast("long"))

    def ratio(k):
        return (marked - k).cast("double") * (drawn - k) / ((k + 1).cast("double") * (total - marked - drawn + k + 1))

    one, zero = F.lit(1.0), F.lit(0.0)
    weight = F.aggregate(
        counts, F.struct(one.alias("w"), zero.alias("sum")),
        lambda acc, k: F.struct((acc["w"] * ratio(k)).alias("w"), (acc["sum"] + acc["w"]).alias("sum")),
    )["sum"]
    return F.aggregate(
        counts, F.struct(one.alias("w"), zero.alias("sum"), least.alias("x"), (chance * weight).alias("goal")),
        lambda acc, k: F.struct(
            (acc["w"] * ratio(k)).alias("w"),
            (acc["sum"] + acc["w"]).alias("sum"),
            F.when(acc["sum"] <= acc["goal"], k).otherwise(acc["x"]).alias("x"),
            acc["goal"].alias("goal"),
        ),
    )["x"]


def shard_quotas(sources: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """``shard, sid, quota``: exact block quotas of every shard, by the splitting tree.

    A node holds one quota per source; levels are steps of one plan, written now and then so
    that its nodes are dealt to more tasks.
    """
    total = sources.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-total // shard_blocks))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("sid", "quota"))), lambda r: r["quota"])
    nodes = sources.agg(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), ordered.alias("quotas"))

    def upto(shard):  # draws of the shards before; even to one block
        return (shard.cast("decimal(20,0)") * total / shards).cast("decimal(20,0)").cast("long")

    def left_share(quotas, drawn, low, high):
        def draw(acc, quota, i):
            chance = F.pmod(F.xxhash64(F.lit(seed), low, high, i), F.lit(1 << 53)) / F.lit(float(1 << 53))
            return hypergeometric(acc["total"], quota, acc["drawn"], chance)

        start = F.struct(
            F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q).alias("total"),
            drawn.alias("drawn"),
            F.array().cast("array<long>").alias("out"),
        )

        def step(acc, entry):
            x = draw(acc, entry["q"], entry["i"])
            return F.struct(
                (acc["total"] - entry["q"]).alias("total"),
                (acc["drawn"] - x).alias("drawn"),
                F.concat(acc["out"], F.array(x)).alias("out"),
            )

        entries = F.transform(quotas, lambda q, i: F.struct(q.alias("q"), i.alias("i")))
        return F.aggregate(entries, start, step)["out"]

    low, high, quotas = F.col("low"), F.col("high"), F.col("quotas")
    middle = F.floor((low + high) / 2)
    for level in range((shards - 1).bit_length()):
        if level % 6 == 5:
            nodes = settle(nodes.repartition("low"), "mix-tree")
        split = nodes.withColumn("middle", middle).withColumn(
            "taken", F.when(high - low > 1, left_share(quotas, upto(F.col("middle")) - upto(low), low, high))
        )
        rest = F.zip_with("quotas", "taken", lambda q, x: q - x)
        children = F.when(
            high - low > 1,
            F.array(
                F.struct("low", F.col("middle").alias("high"), F.col("taken").alias("quotas")),
                F.struct(F.col("middle").alias("low"), "high", rest.alias("quotas")),
            ),
        ).otherwise(F.array(F.struct("low", "high", "quotas")))
        nodes = split.select(F.explode(children).alias("n")).select("n.low", "n.high", "n.quotas")
    rows = nodes.select(F.col("low").alias("shard"), F.posexplode("quotas").alias("sid", "quota"))
    return rows.select("shard", F.col("sid").cast("long"), "quota").where("quota > 0")


def permuted(draw: Column, size: Column, key: Column, stride: Column) -> Column:
    """Place of ``draw`` in the permutation of 0 .. size - 1 that belongs to the text ``key``.

    Steps of a fixed stride from a start given by the key: successive draws lie far apart and
    any number of them is spread evenly over the source.
    """
    start = F.conv(F.substring(F.md5(key.cast("binary")), 1, 7), 16, 10).cast("long")
    return (draw.cast("long") * stride + start) % size


def draws(sources: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """``shard, position, sid, pass, block``: each shard's blocks in its own hash order."""
    quotas = settle(shard_quotas(sources, shard_blocks, seed), "mix-quotas")
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("quota").over(before), F.lit(0))
    rows = (
        quotas.withColumn("first", first)
        .withColumn("draw", F.explode(F.sequence("first", F.col("first") + F.col("quota") - 1)))
        .join(sources.select("sid", "blocks"), "sid")
        .withColumn("pass", F.floor(F.col("draw") / F.col("blocks")).cast("int"))
    )
    stride = F.when(F.col("pass") == 0, F.lit(STRIDES[0])).otherwise(F.lit(STRIDES[1]))
    key = F.concat_ws("|", F.lit(str(seed)), F.col("sid").cast("string"), F.col("pass").cast("string"))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "sid", "draw"), "sid", "draw")
    return rows.select(
        "shard",
        (F.row_number().over(local) - 1).alias("position"),
        "sid",
        "pass",
        permuted(F.col("draw") % F.col("blocks"), F.col("blocks"), key, stride).alias("block"),
    )


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """The sized documents with ``sid`` and ``start``, their first word in their source.

    Documents without words have no start. Repeated ids follow each other by ``form``.
    """
    digits = 0
    rows = sizes.count()
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    dealt = sizes.join(
        sources.select(F.col("source").alias("s"), "sid", "source_size", "target", "blocks"), F.col("source").eqNullSafe(F.col("s"))
    ).withColumn("bucket", F.substring("place", 1, digits))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("sid", "bucket").orderBy("place", "doc_id", "form").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    return dealt.join(sums, ["sid", "bucket"]).withColumn("start", F.when(F.col("size") > 0, at)).drop("s", "offset", "bucket")


def spans(rows: DataFrame, drawn: DataFrame) -> DataFrame:
    """The mix: ``shard, position, pass, sid, start, from, words`` per document and drawn block.

    ``from`` is the first word of the document that the block takes.
    """
    n, size = F.col("blocks").cast("decimal(19,0)"), F.col("source_size")
    block_of = lambda word: F.floor(((word + 1) * n - 1) / size).cast("long")
    begin = lambda block: F.floor(block.cast("decimal(19,0)") * size / n).cast("long")
    end = F.col("start") + F.col("size")
    cut = (
        rows.where("size > 0")
        .withColumn("block", F.explode(F.sequence(block_of(F.col("start")), block_of(end - 1))))
        .withColumn("from", F.greatest(begin(F.col("block")), F.col("start")) - F.col("start"))
        .withColumn("words", F.least(begin(F.col("block") + 1), end) - F.col("start") - F.col("from"))
        .where("words > 0")
        .select("sid", "block", "start", "from", "words")
    )
    return cut.join(drawn, ["sid", "block"]).select("shard", "position", "pass", "sid", "start", "from", "words")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED):
    """The documents with their places, and the spans that the mix takes of them.

    Nulls: a null text has no words, a null source is a source of its own, null ids share a
    place by their text. Of repeated rows each has its own words. An empty table gives
    nothing. Reruns draw the same blocks. A source may hold up to 2^31 blocks.
    """
    sizes = settle(sized(docs), "mix-sizes")
    sources = settle(targets(sizes, weights, share, cap), "mix-sources")
    rows = settle(placed(sizes, sources), "mix-places")
    return rows, spans(rows, draws(sources, seed=seed))


def mixed_documents(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED, ordered=False
) -> DataFrame:
    """The mix as documents: a row for each document and pass that takes words of it.

    ``ordered`` gives them in mixed order, by the shard and position of the first block that
    takes words of them; it moves the texts once more.

    A document that is taken in part has the words of its drawn blocks, with the white space
    after each word. All columns are kept. Rows that repeat id, source and text stand for
    each other: there is a row for each draw of any of them.
    """
    rows, taken = mix(docs, weights, share, cap, seed)
    taken = taken.groupBy("sid", "start", "pass").agg(
        F.min(F.struct("shard", "position", "start")).alias("order"),
        F.sum("words").alias("words"), F.array_sort(F.collect_list(F.struct("from", "words"))).alias("cuts")
    )
    key = rows.where("size > 0").select("sid", "start", "size", *[F.col(c).alias(f"key_{c}") for c in ("doc_id", "source", "form")])
    taken = taken.join(key, ["sid", "start"])
    each = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("key_doc_id"),
        F.col("source").cast("string").alias("key_source"),
        F.xxhash64(whole()).alias("key_form"),
    ).dropDuplicates(["key_doc_id", "key_source", "key_form"])
    same = [taken[c].eqNullSafe(each[c]) for c in ("key_doc_id", "key_source", "key_form")]
    found = each.join(taken, same[0] & same[1] & same[2])
    words = F.regexp_extract_all("row.text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    pieces = F.transform("cuts", lambda c: F.array_join(F.slice("all", (c["from"] + 1).cast("int"), c["words"].cast("int")), ""))
    part = F.rtrim(F.array_join(pieces, ""))
    text = F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(part)
    found = found.withColumn("all", F.when(F.col("words") < F.col("size"), words)).withColumn("cut", text)
    if ordered:
        found = found.select("row", "cut", "order").orderBy("order", "row.doc_id")
    return found.select(*[F.col("cut").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, taken = mix(documents(spark, sf_dir))
    taken = taken.groupBy("sid", "start").agg(F.sum("words").alias("taken"))
    return rows.join(taken, ["sid", "start"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5('mix|' || coalesce(cast(doc_id as varchar), '')) as place
  from documents),
s0 as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as sid from d group by source),
s1 as (select *, [5, 2, 1][(sid % 3)::int + 1] as weight, 2 * source_size as most from s0),
s2 as (select *, row_number() over (order by most / weight, sid) as turn,
         1.5::double * sum(source_size) over () - coalesce(sum(most) over (order by most / weight, sid rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(weight) over () - coalesce(sum(weight) over (order by most / weight, sid rows between unbounded preceding and 1 preceding), 0) as heft
       from s1),
o as (select turn, rest, heft from s2 where rest * weight <= most * heft order by turn limit 1),
s as (select s2.source, sid, source_size,
        case when o.turn is null or s2.turn < o.turn then most::double else o.rest * weight / o.heft end as target,
        greatest(ceil(source_size / 2048)::bigint, least(source_size, 4096)) as n
      from s2 left join o on true),
q as (select *, case when source_size > 0 then floor(target * n / source_size + 0.5)::bigint else 0 end as quota from s),
drawn as (select sid, (draw % n * case when draw < n then 2654435761 else 2246822519 end
          + ('0x' || substr(md5('17|' || sid || '|' || (draw // n)), 1, 7))::bigint) % n as block, count(*) as times
          from (select sid, n, unnest(range(0, quota)) as draw from q) r group by 1, 2),
p as (select d.doc_id, size, q.sid, source_size, target, n,
        sum(size) over (partition by q.sid order by place, doc_id)::bigint - size as start
      from d join q on d.source is not distinct from q.source),
b as (select doc_id, sid, start, size, source_size, n,
        unnest(range(((start + 1)::hugeint * n - 1)::bigint // source_size, (((start + size)::hugeint * n - 1)::bigint // source_size) + 1)) as block
      from p where size > 0),
t as (select doc_id, sum(times * (least((block + 1) * source_size // n, start + size) - greatest(block * source_size // n, start)))::bigint as taken
      from b join drawn using (sid, block) group by 1)
select p.doc_id, size, source_size, target, coalesce(taken, 0) as taken from p left join t using (doc_id)
"""
