"""Documents that the tests of the training-data operators share."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def corpus(seed=5):
    """Rows with copies, near copies, shared passages, nulls, empty and long texts."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 60))
    line = " ".join(words(rng, 12))
    rows = []
    for i in range(120):
        text = "\n".join(" ".join(words(rng, rng.randrange(1, 40))) for _ in range(rng.randrange(1, 5)))
        if i % 7 == 0:
            text += f"\n{passage} {i}"
        if i % 5 == 0:
            text += "\n" + line
        if i % 11 == 0 and rows:
            text = rows[i // 2][1]
        if i % 13 == 0 and rows and rows[i // 2][1]:
            text = rows[i // 2][1] + " last"
        rows.append((i, text, ("en", "de", None)[i % 3], None if i % 10 == 9 else f"s{min(i % 4, 2)}", 1))
    rows[3] = (3, None, "en", "s1", None)
    rows[4] = (4, "", "en", "s1", 0)
    rows[6] = (6, " \t\n ", None, None, 4)
    rows[8] = (8, " ".join(words(rng, 30_000, 5000)), "en", "s0", 1)
    rows += [(200, "same row again and again", "en", "s0", 1)] * 2
    rows += [(None, "a row without an id", "en", "s2", 1), (None, None, None, None, None)]
    return rows


CLASHES = (
    "block bucket kind data fp first root key row rest form turn bin deal rank size sid start place "
    "words pass cut all spans rules candidate parts matches found n_words score features digest h"
).split()


def same(a, b):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
