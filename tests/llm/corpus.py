"""Small tables with every awkward case, and plain versions of what the operators compute."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, id int, size string, key string, row string, n int, dest int, part string, rank int"


def vocabulary(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéöñ") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def rows(seed=5):
    """(doc_id, text, source): exact and near copies, shared passages, nulls, empty and very long texts."""
    rng, words = random.Random(seed), vocabulary(300)
    passage = sentence(rng, words, 70)
    out = [(0, sentence(rng, words, 40), "a"), (1, None, "b"), (2, "", None), (3, " \t\n ", "a"), (4, "One", "b")]
    base = sentence(rng, words, 120)
    out += [(5, base, "a"), (6, base, "a"), (7, base.upper(), "b"), (8, base + " tail", "ü"), (9, base.replace(" ", "\n", 3), "a")]
    near = base.split()
    near[60] = "changed"
    out += [(10, " ".join(near), "a"), (11, passage, "b"), (12, sentence(rng, words, 30) + " " + passage + " " + sentence(rng, words, 9), "a")]
    out += [(13, passage + " " + passage, "c"), (14, sentence(rng, words, 30_000), "c"), (15, "word " * 200, "c"), (16, "a\n\nb\n\nb", None)]
    out += [(20 + k, sentence(rng, words, rng.randint(1, 90)) + "\n" + sentence(rng, words, 8), rng.choice("abc")) for k in range(40)]
    chain = sentence(rng, words, 60).split()
    for k in range(6):  # neighbours are near, ends are not
        out.append((70 + k, " ".join(chain), "d"))
        chain[7 * k] = f"x{k}"
    return out


def frame(spark, data):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 7, "s", "k", "r", 1, 2, "p", 3) for r in data], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)
