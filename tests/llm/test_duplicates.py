"""Near duplicates, repeated passages and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpus import WORD, frame, lower, rows, sentence, vocabulary
from pyspark.sql import functions as F

from vitalis.llm import near_duplicates as near
from vitalis.llm import repeats, sketches
from vitalis.llm.common import window_hashes, word_bounds, word_hashes, text_bytes
from vitalis.llm.components import components


def shingles(text):
    words = WORD.findall(lower(text or ""))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def find(parent, a):
    while parent[a] != a:
        a = parent[a]
    return a


def groups(data):
    """Component of each id by comparing all pairs."""
    sets = [(doc, shingles(text)) for doc, text, _ in data if doc is not None]
    parent = {doc: doc for doc, _ in sets}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(parent, a), find(parent, b)))
                parent[q] = p
    return {doc: find(parent, doc) for doc in parent}


def test_near_duplicates(spark):
    data = rows() + [(5, "other words under an id that is taken already", "a"), (None, "no id at all", "a")]
    got = near.near_duplicates(frame(spark, data)).collect()
    want = groups(data)
    assert len(got) == len(want) + 1
    sizes = defaultdict(int)
    for doc, text, _ in data:
        sizes[doc] = max(sizes[doc], len(shingles(text)))
    for r in got:
        assert r["n_shingles"] == sizes[r["doc_id"]]
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or want[r["doc_id"]] == r["doc_id"])
    assert want[10] == want[5] == 5 and len({want[k] for k in range(70, 76)}) == 1


def test_texts_of_equal_size_under_one_id_keep_their_links(spark):
    rng, words = random.Random(9), vocabulary(300)
    data = []
    for k in range(8):  # an id with three texts of 60 words, each with a near copy under another id
        for j in range(3):
            text = sentence(rng, words, 60)
            data += [(k, text, "a"), (100 + 10 * k + j, text + " tail", "a")]
    want = groups(data)
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(frame(spark, data)).collect()}
    assert got == want and set(want.values()) == set(range(8))


def test_near_duplicates_of_empty_table(spark):
    assert near.near_duplicates(frame(spark, [])).collect() == []


def test_large_group_of_near_copies(spark):
    base = [f"w{k}" for k in range(80)]
    data = [(k, " ".join(base[:40] + [f"v{k}"] + base[41:]), "a") for k in range(300)]
    got = near.near_duplicates(frame(spark, data)).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_estimate_is_near_the_truth(spark):
    a, b = " ".join(f"w{k}" for k in range(200)), " ".join(f"w{k}" for k in range(40, 240))
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": [a, b]})
    signed = pa.Table.from_batches(near._signatures(iter([batch])))
    x, y = (spark.createDataFrame([(v,)], "bits array<long>") for v in signed["bits"].to_pylist())
    pair = x.toDF("a").crossJoin(y.toDF("b")).select(near.estimate(F.col("a"), F.col("b"))).first()[0]
    truth = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert abs(pair - truth) < 0.2


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (300, 200), (200, 250)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[k] for k in range(41)} == {0} and got[101] == 100 and got[300] == got[250] == got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def cut(data):
    """Kept words by comparing all windows."""
    first = {}
    for doc, text, _ in data:
        words = WORD.findall(text or "")
        for k in range(len(words) - 49):
            key = tuple(words[k : k + 50])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text, _ in data:
        words, gone = WORD.findall(text or ""), set()
        for k in range(len(words) - 49):
            if doc is not None and first[tuple(words[k : k + 50])] < doc:
                gone |= set(range(k, k + 50))
        out.append((doc, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("parts", [1, 5])
def test_repeats(spark, parts):
    data = rows()
    data += [(5, "other " + data[5][1], "a"), (None, data[5][1], "a"), (13, data[13][1], "a")]
    got = repeats.remove_repeats(frame(spark, data).repartition(parts)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == cut(data)
    for r in got:
        spans = list(zip(r["spans"][::2], r["spans"][1::2]))
        assert sum(b - a for a, b in spans) == r["n_removed"] and all(b - a >= 50 for a, b in spans)


def test_repeats_digest_and_empty_table(spark):
    data = rows()[:13]
    texts = {r["doc_id"]: r["kept_text"] for r in repeats.remove_repeats(frame(spark, data)).collect()}
    for r in repeats.remove_repeats(frame(spark, data), digest=True).collect():
        assert r["kept_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert repeats.remove_repeats(frame(spark, [])).collect() == []


def paragraphs(text):
    return {p for p in text.split("\n") if p}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark):
    data = rows() + [(200, "\n".join(f"line {k}" for k in range(3000)), "a"), (201, "\n".join(f"line {k}" for k in range(40, 3100)), "a")]
    got = {r["doc_id"]: r for r in sketches.fingerprints(frame(spark, data).repartition(4)).collect()}
    order = sorted(data)
    for k, (doc, text, _) in enumerate(order):
        text, following, r = text or "", order[(k + 1) % len(order)][1] or "", got[doc]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(likeness(text, edited), abs=1e-12)
        assert r["near_next"] == pytest.approx(likeness(text, following), abs=1e-12)
    assert got[5]["fingerprint"] == got[6]["fingerprint"] != got[0]["fingerprint"]


def test_fingerprints_of_one_no_and_repeated_rows(spark):
    (alone,) = sketches.fingerprints(frame(spark, [(1, "a\nb", "s")])).collect()
    assert (alone["near_edited"], alone["near_next"]) == (likeness("a\nb", "a\na"), 1.0)
    assert sketches.fingerprints(frame(spark, [])).collect() == []
    got = sketches.fingerprints(frame(spark, [(1, "a", "s"), (1, "a", "s"), (None, "b", "s")])).collect()
    assert sorted((r["doc_id"] is None, r["near_next"]) for r in got) == [(False, 0.0), (False, 1.0), (True, 0.0)]


def pieces(text):
    """By the module's two patterns: a document's start, and the rest."""
    return re.findall(sketches.WORDS, text[: sketches.FIRST]) + re.findall(sketches.LONGER, text[sketches.FIRST :])


def test_short_documents_keep_pieces_too(spark):
    words, rng = vocabulary(400), random.Random(5)
    data = [(k, sentence(rng, words, 8 + k % 9), "a") for k in range(60)]
    got = sketches.fingerprints(frame(spark, data), pieces=True).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in got) == len(data)


def test_documents_of_every_length_split_alike(spark):
    """One section, sections within the row, and sections dealt by a shuffle; equal arrays have no row."""
    schema = "row long, pair int, expected double, a array<long>, b array<long>"
    cases = [(n, 0, 0.5, list(range(n)), list(range(n // 2, n + n // 3))) for n in (1, 7, 60, 900, 5000)]
    cases.append((8, 1, 0.5, [1, 2, 3], [1, 2, 3]))
    got = {r["row"]: r["apart"] for r in sketches.differences(spark.createDataFrame(cases, schema), listed=False).collect()}
    assert got == {n: n // 2 + n // 3 for n in (1, 7, 60, 900, 5000) if n // 2 + n // 3}


def test_edits_inside_a_line_keep_the_other_pieces(spark):
    words = vocabulary(400)
    rng = random.Random(3)
    data = [(k, sentence(rng, words, 12 + 30 * k), "a") for k in range(12)]  # one line each
    data += [(50, "".join(rng.choice("的是不了人我在有他这中大来上国") for _ in range(9000)), "a"), (51, f"{rng.getrandbits(60000):x}", "a")]
    data += [(60, sentence(rng, words, 9000), "a"), (61, "z" * 500, "a"), (62, "", "a"), (63, None, "a")]
    got = {r["doc_id"]: r for r in sketches.fingerprints(frame(spark, data).repartition(4), pieces=True).collect()}
    cut = lambda text: set(pieces(text))
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (doc, text, _) in enumerate(data):
        text, following = text or "", data[(k + 1) % len(data)][1] or ""
        half = len(text) // 2
        assert "".join(pieces(text)) == text.replace("\n", "") and all(len(p) <= 400 for p in cut(text))
        assert got[doc]["near_edited"] == pytest.approx(share(cut(text), cut(text[: len(text) - half] + following[:half])), abs=1e-12)
        assert got[doc]["near_next"] == pytest.approx(share(cut(text), cut(following)), abs=1e-12)
        if doc < 61:
            assert got[doc]["near_edited"] > max(0.1, got[doc]["near_next"])
            assert share(cut(text), cut("word " + text)) > 0.3  # an insertion moves few cuts


def test_peeling_recovers_the_digests(spark):
    df = spark.createDataFrame([(1, 0, 1.0, list(range(10, 300)), list(range(100, 420)))], "row long, pair int, expected double, a array<long>, b array<long>")
    (r,) = sketches.differences(df).collect()
    assert sorted(r["removed"]) == list(range(10, 100)) and sorted(r["added"]) == list(range(300, 420))


def test_word_hashes():
    texts = pa.array(["a b  a", "", "b\ta", "ab"])
    data, offsets = text_bytes(texts)
    starts, ends, first = word_bounds(data, offsets)
    h = word_hashes(data, starts, ends)
    assert first.tolist() == [0, 3, 3, 5, 6] and h[0] == h[2] == h[4] and h[1] == h[3] and len(set(h.tolist())) == 3
    w = window_hashes(np.array([1, 2, 3, 1, 2, 3, 9], dtype=np.uint64), 3)
    assert w[0] == w[3] and len(set(w.tolist())) == 4
