"""The conversation trie, collocations and MinHash near-dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_corpus import SCHEMA, same
from pyspark.sql import functions as F

from skylattice.llm import collocations, conversations, minhash
from skylattice.llm.radix import Full, Indexed, RadixTree, Sorted, common

TURNS = "conv_id long, turn long, role string, text string"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# radix trees


def test_radix_tree_is_a_map():
    rng = random.Random(1)
    tree, plain = RadixTree(), {}
    for _ in range(3000):
        key = bytes(rng.choice((0, 1, 2, 255)) if rng.random() < 0.8 else rng.randrange(256) for _ in range(rng.randrange(7)))
        value = rng.randrange(1000)
        tree.insert(key, value)
        plain[key] = value
    assert all(tree.get(k) == v for k, v in plain.items())
    assert tree.get(b"not there") is None
    found, paths = [], {id(tree.root): b""}

    def walk(node, path):
        if node.value is not None:
            found.append((path, node.value))
        for child in node.children:
            walk(child, path + child.path)

    walk(tree.root, b"")
    assert found == sorted(plain.items())  # in the order of the bytes
    assert paths


def test_radix_layouts_grow():
    tree, kinds = RadixTree(), {}
    for n, b in enumerate(random.Random(2).sample(range(256), 256), 1):
        tree.insert(bytes([b, 1, 2, 3]), n)
        kinds[n] = tree.root.children
        children = list(tree.root.children)
        assert len(children) == n and [c.path for c in children] == sorted(c.path for c in children)
    assert isinstance(kinds[4], Sorted) and kinds[4].room == 4
    assert isinstance(kinds[16], Sorted) and kinds[16].room == 16
    assert isinstance(kinds[48], Indexed) and isinstance(kinds[49], Full)
    assert all(c.path[1:] == b"\1\2\3" for c in tree.root.children)  # compressed


def test_common_bytes():
    rng = random.Random(3)
    for _ in range(500):
        a, b = (bytes(rng.randrange(2) for _ in range(rng.randrange(12))) for _ in "ab")
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common(a, b) == want


# conversations


def talks(seed, ids=90, pool=4):
    rng = random.Random(seed)
    rows = []
    for c in range(ids):
        for t in range(rng.choice((0, 1, 1, 2, 3, 5, 9))):
            rows.append((c * 7 % 97, None if t == 0 and c % 5 == 0 else t, rng.choice(("user", None, "assistant")), rng.choice(("a b", "c", None, "  ", "x y z")[: pool + 1])))
    rows += [(1000 + i, t, "user", f"same {t}") for i in range(30) for t in range(4)]  # copies
    rows += [(2000, t, "user", f"long {t % 3}") for t in range(400)]
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    return rows


def plain_trie(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0))] for c, v in by.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, own_ in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own_) - 1) * len(split(node[-1][1])) if node else 0
    return [
        (
            m[0], len(n), members[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(str(c) for c in m if len(whole[c]) == len(n)).encode()).hexdigest(),
        )
        for n, m in members.items()
    ]


def trie(df, *args):
    return conversations.prefix_trie(conversations.with_shared_heads(conversations.turn_ids(df)), *args)


@pytest.mark.parametrize("chunk", [1, 3, conversations.CHUNK_KEYS])
def test_prefix_trie(spark, chunk):
    rows = talks(chunk)
    found = trie(spark.createDataFrame(rows, TURNS).repartition(3), chunk).collect()
    assert same(found, plain_trie(rows))


def test_prefix_trie_edges(spark):
    assert trie(spark.createDataFrame([], TURNS)).count() == 0
    assert trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0
    rows = [(5, None, None, None), (5, None, None, None), (5, 3, "u", "one two")]  # repeated rows are turns
    assert same(trie(spark.createDataFrame(rows, TURNS)).collect(), plain_trie(rows))
    plain = spark.createDataFrame(talks(9), TURNS)
    extra = plain.withColumns({c: F.lit("x") for c in ("ids", "path", "block", "key", "base", "chunk", "depth", "node")})
    assert same(trie(plain).collect(), trie(extra).collect())


# collocations


def plain_collocations(rows, least, inside, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in found.items():
            cuts = [(1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            longer = [f for q, f in found.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if not any(100 * f >= inside * a for f in longer):
                best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return out


def chatter(seed):
    rng = random.Random(seed)
    words = ["New", "york", "É", "the", "of", "x y", "a-b", "q"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "! "]) for _ in range(rng.randrange(120)))
        rows.append((i, text, rng.choice(["en", None, "und", "de"]), "s", 1))
    return rows + [(None, None, None, None, None), (7, "", "en", "s", 0), (8, " . \n", "fr", "s", 0), (9, "lone", "es", "s", 0)]


@pytest.mark.parametrize("least, inside, top", [(10, 50, 2000), (2, 80, 5), (1, 1, 40)])
def test_collocations(spark, least, inside, top):
    rows = chatter(least) * 2  # repeated rows count twice
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), 3, least, inside, top).collect()
    assert found and same(found, plain_collocations(rows, least, inside, top))


def test_collocations_on_documents(spark, docs, rows, clashing, empty):
    found = collocations.collocations(docs).collect()
    assert same(found, plain_collocations(rows, 10, 50, 2000))
    assert same(collocations.collocations(clashing).collect(), found)
    assert collocations.collocations(empty).count() == 0


def test_large_counts_are_exact(spark):
    a, left, right = 9_876_543_210_987, 12_345_678_901_234, 98_765_432_109_876
    found = spark.range(1).select(collocations._score(f"{a}L", f"{left}L", f"{right}L").alias("s")).first().s
    assert found == 1_000_000 * a * a // (left * right)


def test_windows_are_exploded_once(spark, docs):
    plan = collocations.frequent_phrases(docs)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Generate inline") == 1


def test_different_windows_move_packed(spark):
    """Windows that are all different take some bytes each, not a row with their words."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"word{rng.randrange(2000)}" for _ in range(2000)), "en", "s", 1) for i in range(40)]
    found = collocations.windows(spark.createDataFrame(rows, SCHEMA).coalesce(1)).toArrow()
    sent = collocations.send_phrases(found, 4)
    assert sent.nbytes < 16 * found.num_rows
    counts = Counter()
    for _, text, *_ in rows:
        w = text.split()
        for k in (1, 2, 3):
            counts.update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    met = [collocations.meet_phrases(pa.Table.from_batches([sent]).slice(i, 1), 3).to_pylist() for i in range(sent.num_rows)]
    assert {r["phrase"]: r["f"] for m in met for r in m if r["words"]} == {p: f for p, f in counts.items() if f >= 3}
    assert sum(r["f"] for m in met for r in m if not r["words"]) == found.num_rows


# MinHash


def shingle_set(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = split(w)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_components(rows, similarity=85):
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= similarity * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        component = least.get(top(i)) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), component, component is None or component == r[0]))
    return out


def copies(seed=3):
    """Groups around the threshold, chains, and a template whose copies differ at places of their own."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for i in range(40):
        base = [word() for _ in range(rng.randrange(3, 300))]
        texts.append(base)
        for _ in range(4):
            copy = list(texts[-1] if i % 2 else base)  # a chain or a star
            for _ in range(rng.randrange(0, max(2, len(base) // 35))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    fixed = [word() for _ in range(300)]
    for _ in range(80):
        texts.append([word() if rng.random() < 0.012 else w for w in fixed])
    rng.shuffle(texts)
    rows = [(i, (" ".join(t)).title() if i % 3 else "\n".join(t), "en", "s", 1) for i, t in enumerate(texts)]
    return rows + [(None, rows[0][1], None, None, None), (None, None, None, None, None), (900, "\t \n", "en", "s", 1), (901, "", None, None, 0)]


def test_minhash_components_are_those_of_all_pairs(spark):
    rows = copies()
    want = plain_components(rows)
    assert 60 < sum(r[3] for r in want) < len(rows) - 60
    assert same(minhash.near_dedup(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect(), want)


def crowd(n, seed=8):
    """A template whose copies change a tenth at places of their own, a few of them with near copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(100_000)}"
    fixed, texts = [word() for _ in range(150)], []
    for i in range(n):
        cut = rng.randrange(3, 25)
        texts.append(fixed[: -cut] if i % 2 else fixed[cut:])
        if i % 3 == 0:
            texts[-1] = [word() if rng.random() < 0.03 else w for w in texts[-1]]
        for _ in range(i % 10 == 0):
            copy = list(texts[-1])
            copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    return [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]


def test_minhash_in_a_crowd_is_that_of_all_pairs(spark):
    rows = crowd(150)
    found = minhash.near_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = plain_components(rows)
    assert 5 < sum(r[3] for r in want) < len(rows) - 20 and same(found, want)


def test_what_sets_unlike_copies_apart_makes_no_pairs(spark):
    """Sets that changed a tenth at places of their own share no difference that could link them."""
    rng = np.random.default_rng(5)
    fixed, sets = np.arange(1, 201), {b"head": np.arange(1, 201)}
    for i in range(100):
        own = 1000 * (i + 1) + np.arange(20)
        sets[b"%03d" % i] = np.sort(np.append(np.delete(fixed, rng.choice(200, 20, False)), own))
    sets[b"copy"] = np.append(sets[b"007"][:-1], 10**6)
    rows = [(node, x.astype(np.uint64).tobytes()) for node, x in sets.items()]
    pairs = spark.createDataFrame([(b"head", node, len(x)) for node, x in sets.items()], "head binary, node binary, n long")
    found = minhash._differences(pairs, spark.createDataFrame(rows, "node binary, hashes binary"), 85).collect()
    by = defaultdict(list)
    for r in found:
        by[r.element].append((bytes(r.node), r.d, r.i))
    n = {node: len(x) for node, x in sets.items()}
    met = {
        tuple(sorted((a, b)))
        for some in by.values() for a, d, i in some for b, e, j in some
        if a != b and 185 * (i + j + abs((d - i) - (e - j))) <= 15 * (n[a] + n[b])
    }
    assert (b"007", b"copy") in met and len(met) < 10


def test_minhash_on_documents(spark, docs, rows, clashing, empty):
    found = minhash.near_dedup(docs).collect()
    assert same(found, plain_components(rows))
    assert same(minhash.near_dedup(clashing).collect(), found)
    assert minhash.near_dedup(empty).count() == 0


def test_pairs_are_given_up_by_their_posterior():
    # P(s >= t | m of k), the posterior integrated in small steps
    t, miss = 0.7, 1e-3
    for k, m in zip((32, 64, 96), minhash.least_matches(t, miss)):
        def chance(x):
            grid = [(i + 0.5) / 20000 for i in range(20000)]
            density = [s**x * (1 - s) ** (k - x) for s in grid]
            return sum(d for s, d in zip(grid, density) if s >= t) / sum(density)

        assert chance(m) >= miss > chance(m - 1)


def test_signatures_estimate_similarity():
    a = " ".join(f"w{i}" for i in range(1000))
    b = " ".join(f"w{i}" if i % 97 else "x" for i in range(1000))
    x, y = (minhash.signature(minhash.shingle_sets([t])[0]) for t in (a, b))
    p, q = shingle_set(a), shingle_set(b)
    assert abs((x == y).mean() - len(p & q) / len(p | q)) < 0.1
