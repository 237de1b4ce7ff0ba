"""The prefix trie of conversations, from adaptive radix trees over turn ids.

A turn's id has a fixed width: 16 bytes of a digest of role and text, and the number of words
of the text, big-endian. A conversation is the string of its ids, so each prefix of d turns is
a prefix of ``WIDTH * d`` bytes, and only depths that are multiples of ``WIDTH`` are nodes of
the trie; all other forks and shared paths of the radix tree are within an id.

1. Conversations with the same turns are one string with blocks of their conv_ids.
2. Strings are dealt to tasks by ranges and arrive in order. A task builds a radix tree per
   chunk of bounded size and walks it upwards once. A node whose strings all lie within the
   chunk is final there, with all sums over its subtree.
3. Only prefixes of a chunk's first or last string can go on in a neighbour. Their counts and
   sums are added up by a digest of the prefix. Where two chunks meet, the nodes on both sides
   are counted once too often; what that adds or takes is known from the border alone, for all
   ancestors at once: a node on d shared turns saves the words of the shared turns from d on
   once more, has a child less, and a leaf less if the earlier string ends there.

So no task holds more than a chunk, whatever the number of conversations that share a turn,
and no step is repeated per depth.
"""

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.llm.radix import RadixTree, common
from skylattice.llm.text import WORD, whole
from skylattice.session import settle

DIGEST, WORDS = 16, 4  # bytes of an id
WIDTH = DIGEST + WORDS
CHUNK_KEYS, CHUNK_BYTES = 20_000, 4_000_000  # strings of a chunk, whichever bound is met first
BLOCK_BITS = 12  # conv_ids that differ in these bits only are one block
GROUP = 20  # conversations that share the head of the first of them
HEADS = 4  # heads have 0 to 3 turns

EMPTY = hashlib.sha256(b"").hexdigest()
CLOSED, OPEN, EDGE = 0, 1, 2
FIELDS = [
    ("kind", "int"), ("chunk", "long"), ("slot", "long"), ("conv_id", "long"), ("depth", "long"),
    ("digest", "binary"), ("parent", "binary"), ("parent_slot", "long"), ("parent_conv_id", "long"),
    ("n_convs", "long"), ("n_children", "long"), ("n_leaves", "long"), ("saved_tokens", "long"),
    ("ends", "string"), ("first_key", "binary"), ("last_key", "binary"),
]
NAMES = [n for n, _ in FIELDS]
DDL = ", ".join(f"{n} {t}" for n, t in FIELDS)
TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def turn_ids(turns: DataFrame) -> DataFrame:
    """``conv_id, ids``: each conversation's turn ids as hexadecimal digits, in order.

    Turns are ordered by ``turn``, null first, and ties by their ids, so repeated rows are
    turns of their own. A null role or text is empty. Rows without a conv_id belong to no
    conversation and are left out. Columns with other names are ignored.
    """
    role, text = whole("role"), whole("text")
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)
    words = F.lower(F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 2 * WORDS, "0"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.concat(digest, words).alias("id")
    )
    found = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("turns"))
    return found.select("conv_id", F.col("turns.id").alias("ids"))


def with_shared_heads(found: DataFrame) -> DataFrame:
    """``conv_id, ids`` with the first turns taken from the first conversation of the group.

    Conversation c begins with the first h turns of c - c % GROUP (all if it has fewer, none
    if there is no such one), h being the unsigned crc32 of c in decimal modulo HEADS, and goes
    on with its own turns after its first h. ``%`` keeps the sign of c.
    """
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = found.where(f"conv_id % {GROUP} = 0").select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, HEADS - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    rebuilt = F.concat(
        F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h),
        F.slice("ids", h + 1, F.size("ids")),
    )
    return found.withColumn("base", base).join(heads, "base", "left").select("conv_id", rebuilt.alias("ids"))


def prefix_digests(key: bytes, turns: int) -> list[bytes]:
    """A digest per prefix of 0 to ``turns`` turns."""
    h, out = hashlib.sha256(), []
    for d in range(turns + 1):
        if d:
            h.update(key[(d - 1) * WIDTH : d * WIDTH])
        out.append(h.copy().digest())
    return out


def _words(key: bytes, depth: int) -> int:
    """The words of the turn at ``depth``."""
    return int.from_bytes(key[depth * WIDTH - WORDS : depth * WIDTH], "big") if depth else 0


def border(before: bytes, after: bytes) -> list[dict]:
    """What to add to the nodes on the turns that two neighbouring strings share."""
    shared = common(before, after) // WIDTH
    digests, more, out = prefix_digests(before, shared), 0, []
    ends = -1 if len(before) == shared * WIDTH else 0
    for d in range(shared, -1, -1):
        more += _words(before, d)
        out.append(
            dict(
                kind=OPEN, digest=digests[d], parent=digests[d - 1] if d else None, depth=d, n_convs=0,
                n_children=-1 if d < shared else 0, n_leaves=ends, saved_tokens=more,
            )
        )
    return out


class _Above:
    """What lies below a place in the tree: sums, and the nodes that await their parent."""

    __slots__ = ("low", "high", "n", "first", "tops", "leaves", "saved")

    def __init__(self):
        self.low = self.high = self.first = None
        self.n = self.leaves = self.saved = 0
        self.tops = []

    def add(self, low, high, n, first):
        self.low = low if self.low is None else min(self.low, low)
        self.high = high if self.high is None else max(self.high, high)
        self.first = first if self.first is None else min(self.first, first)
        self.n += n


def chunk_nodes(chunk: int, keys: list[bytes], values: list[tuple[int, int, str]]) -> list[dict]:
    """The trie's nodes over strings in order; ``values``: copies, smallest conv_id, their hash."""
    tree, last = RadixTree(), len(keys) - 1
    for i, key in enumerate(keys):
        tree.insert(key, i)
    firsts = prefix_digests(keys[0], len(keys[0]) // WIDTH)
    lasts = prefix_digests(keys[-1], len(keys[-1]) // WIDTH)
    out, done = [], []
    for node, depth, children in tree.upwards():
        here, ends = _Above(), None
        if node.value is not None:
            n, first, ends = values[node.value]
            here.add(node.value, node.value, n, first)
        for child in done[len(done) - children :]:
            here.add(child.low, child.high, child.n, child.first)
            here.tops += child.tops
            here.leaves += child.leaves
            here.saved += child.saved
        del done[len(done) - children :]
        top = depth - len(node.path)  # the parent's own depth is the parent's to emit
        for d in range(depth // WIDTH, -1, -1):
            if d * WIDTH <= top and not (d == 0 and depth == 0):
                break
            # a turn-aligned depth: a node of the trie
            key = keys[here.low]
            row = dict(
                chunk=chunk, depth=d, conv_id=here.first, n_convs=here.n, n_children=len(here.tops),
                ends=ends if d * WIDTH == depth else None,
            )
            here.leaves = row["n_leaves"] = here.leaves or 1
            here.saved += (here.n - 1) * _words(key, d)
            row["saved_tokens"] = here.saved
            slot = 2 * d if here.low == 0 else 2 * d + 1 if here.high == last else None
            if slot is None:
                row["kind"] = CLOSED
                for below in here.tops:
                    below["parent_conv_id"] = here.first
            else:
                digests = lasts if slot % 2 else firsts
                row |= dict(kind=OPEN, slot=slot, digest=digests[d], parent=digests[d - 1] if d else None)
                for below in here.tops:
                    if below["kind"] == CLOSED:
                        below["parent_slot"] = slot
            here.tops = [row]
            out.append(row)
        done.append(here)
    return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], TYPES[t]) for n, t in FIELDS], NAMES)


def _trie(chunk_keys: int, chunk_bytes: int):
    def run(batches):
        task = TaskContext.get().partitionId()
        keys, values, size, number = [], [], 0, 0
        key, n, least, ends = None, 0, None, None
        first = before = None

        def chunk():
            nonlocal keys, values, size, number, before
            rows = chunk_nodes(task << 32 | number, keys, values)
            if before is not None:
                rows += border(before, keys[0])
            before = keys[-1]
            keys, values, size, number = [], [], 0, number + 1
            for at in range(0, len(rows), 10_000):
                yield _batch(rows[at : at + 10_000])

        def close():
            nonlocal size
            keys.append(key)
            values.append((n, least, ends.hexdigest()))
            size += len(key)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for path, ids in zip(some.column("path").to_pylist(), some.column("ids").to_pylist()):
                    if path != key:
                        if key is not None:
                            close()
                            if len(keys) >= chunk_keys or size >= chunk_bytes:
                                yield from chunk()
                        key, n, least, ends = path, 0, ids[0], hashlib.sha256()
                        first = path if first is None else first
                    elif n:
                        ends.update(b",")
                    ends.update(",".join(map(str, ids)).encode())
                    n += len(ids)
                    least = min(least, ids[0])
        if key is not None:
            close()
            yield from chunk()
            yield _batch([dict(kind=EDGE, chunk=task, first_key=first, last_key=key)])

    return run


def prefix_trie(found: DataFrame, chunk_keys: int = CHUNK_KEYS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The trie's nodes over conversations ``conv_id, ids``, each conv_id once.

    conv_id is the smallest member of a node, parent_conv_id that of its parent (null at the
    root), ends_sha256 the hash of the ascending conv_ids that end at the node. Conversations
    without turns are members of the root only; without conversations there is no node.
    One conversation's ids have to fit into a row (20 bytes a turn). The hash of conversations
    that end at one node is taken in order, so by one task, which reads them in blocks.
    """
    path = F.unhex(F.array_join("ids", ""))
    blocks = found.select(path.alias("path"), F.shiftright("conv_id", BLOCK_BITS).alias("block"), "conv_id")
    blocks = blocks.groupBy("path", "block").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = settle(blocks, "trie-strings")
    dealt = blocks.repartitionByRange("path").sortWithinPartitions("path", "block")
    rows = settle(dealt.select("path", "ids").mapInArrow(_trie(chunk_keys, chunk_bytes), DDL), "trie-nodes")

    # where the strings of two tasks meet: one row per task
    edges = rows.where(f"kind = {EDGE}").select("chunk", "first_key", "last_key")
    meet = edges.withColumn("after", F.lead("first_key").over(Window.orderBy("chunk"))).where("after is not null")

    def borders(batches):
        for batch in batches:
            for a, b in zip(batch.column("last_key").to_pylist(), batch.column("after").to_pylist()):
                yield _batch(border(a, b))

    parts = rows.where(f"kind = {OPEN}")
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    opened = parts.unionByName(meet.select("last_key", "after").mapInArrow(borders, DDL)).groupBy("digest").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.max("ends").alias("ends"), *[F.sum(c).alias(c) for c in sums],
    )
    opened = settle(opened, "trie-open")
    named = opened.select(F.col("digest").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    upper = opened.join(named, F.col("parent") == F.col("up"), "left")
    # a closed node below an open one finds it by chunk and place, so no parent is a hot key
    slots = parts.select("chunk", F.col("slot").alias("parent_slot"), F.col("digest").alias("up")).join(named, "up").drop("up")
    closed = rows.where(f"kind = {CLOSED}")
    within = closed.where("parent_slot is null")
    below = closed.where("parent_slot is not null").drop("parent_conv_id").join(slots, ["chunk", "parent_slot"])
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = [x.select(*shown, F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")) for x in (upper, within, below)]
    return nodes[0].unionByName(nodes[1]).unionByName(nodes[2])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(with_shared_heads(turn_ids(turns)))


SQL = r"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, id) - 1 as p, id, words from (
    select conv_id, turn, sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id,
           length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
    from conversations where conv_id is not null)),
-- crc32, bit by bit: a number is a byte to take in, -1 a shift
convs as (
  select conv_id, conv_id - conv_id % 20 as base, (xor(list_reduce(list_prepend(4294967295::bigint,
      flatten(list_transform(string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda x, y: case when y >= 0 then xor(x, y) when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end),
      4294967295) % 4)::bigint as h
  from (select distinct conv_id from turns)),
sizes as (select conv_id as base, count(*) as size from turns group by all),
rebuilt as (
  select c.conv_id, t.p + 1 as d, t.id, t.words from convs c join turns t on t.conv_id = c.base and t.p < c.h
  union all
  select c.conv_id, least(c.h, coalesce(s.size, 0)) + t.p - c.h + 1, t.id, t.words
  from convs c join turns t on t.conv_id = c.conv_id and t.p >= c.h left join sizes s on s.base = c.base),
prefixes as (
  select conv_id, 0 as d, '' as node, '' as up, 0 as words from convs
  union all
  select conv_id, d, sha256(string_agg(id, '') over w) as node,
         case d when 1 then '' else sha256(coalesce(string_agg(id, '') over (partition by conv_id order by d rows between unbounded preceding and 1 preceding), '')) end,
         words
  from rebuilt window w as (partition by conv_id order by d)),
ends as (
  select node, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends
  from (select conv_id, node from prefixes qualify row_number() over (partition by conv_id order by d desc) = 1) group by all),
nodes as (
  select d, node, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words from prefixes group by d, node),
children as (select up as node, count(*) as n_children from nodes where d > 0 group by all),
full_nodes as (
  select n.*, coalesce(c.n_children, 0) as n_children, (n.n_convs - 1) * n.words as own
  from nodes n left join children c on c.node = n.node),
sums as (
  select p.node, sum(f.own)::bigint as saved_tokens, count(*) filter (f.n_children = 0) as n_leaves
  from full_nodes f join prefixes p on p.conv_id = f.conv_id and p.d <= f.d group by all)
select f.conv_id, f.d::bigint as depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens,
       coalesce(e.ends, sha256('')) as ends_sha256
from full_nodes f join sums s on s.node = f.node
     left join nodes u on f.d > 0 and u.node = f.up
     left join ends e on e.node = f.node
"""
