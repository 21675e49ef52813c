"""Hard negatives, languages and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from corpus import WORD, frame, rows, vocabulary
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitalis.llm import language, negatives, periodic, queries

# --- hard negatives ---


def plain_negatives(vectors, is_anchor, positives=5, negatives=5, least=80):
    """vectors: {id: (label, tuple)}."""
    out = []
    for a, (label, v) in vectors.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for i, (lab, w) in vectors.items() if i != a and len(w) == len(v))
        mine = [(i, -s) for s, i, lab in scored if lab == label][:positives]
        for p, ps in mine:
            found = [(i, -s) for s, i, lab in scored if lab != label and least * ps <= 100 * -s <= 100 * ps][:negatives]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(found)]
    return sorted(out)


VECTORS = "vec_id long, label int, vector array<int>, bucket int, id string, score int"


def vector_frame(spark, data):
    return spark.createDataFrame([(i, lab, v, 1, "x", 2) for i, lab, v in data], VECTORS)


def got_negatives(df, every=4, **kw):
    found = negatives.hard_negatives(df, F.col("id") % every == 0, **kw).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found)


def clustered(n, dim, labels, seed, spread=90, lengths=(1.0,)):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(labels, dim)) * 100
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = (middles[label] + rng.normal(size=dim) * spread) * rng.choice(lengths)
        out.append((i, label, [int(x) for x in v]))
    return out


@pytest.mark.parametrize("lengths", [(1.0,), (0.05, 1.0, 30.0)])
def test_negatives_of_clusters(spark, lengths):
    data = clustered(300, 8, 3, 4, lengths=lengths)
    want = plain_negatives({i: (lab, v) for i, lab, v in data}, lambda i: i % 4 == 0)
    assert want and got_negatives(vector_frame(spark, data)) == want


def test_small_buckets_and_tiles_change_nothing(spark, monkeypatch):
    data = clustered(200, 5, 4, 9, lengths=(0.3, 1.0))
    want = plain_negatives({i: (lab, v) for i, lab, v in data}, lambda i: i % 4 == 0)
    monkeypatch.setattr(negatives, "BUCKET", 7)
    monkeypatch.setattr(negatives, "TILE", 3)
    assert got_negatives(vector_frame(spark, data)) == want


def test_awkward_vectors(spark):
    same = [(i, i % 2, [3, 4]) for i in range(40)]  # ties everywhere
    odd = [(40, 0, [0, 0]), (41, 1, [0, 0]), (44, 0, [-5, -2]), (45, 0, [1, 2, 3]), (48, 1, [3, 2, 1]), (52, 1, []), (53, 1, []), (54, 0, [])]
    out = [(60, None, [1, 2]), (64, 1, None), (68, 1, [1, None]), (None, 1, [3, 4])]
    data = same + odd
    want = plain_negatives({i: (lab, v) for i, lab, v in data}, lambda i: i % 4 == 0)
    assert got_negatives(vector_frame(spark, data + out + same[:3])) == want
    twice = [(8, 1, [3, 5]), (8, 0, [3, 6])]  # the least of an id's rows counts
    assert got_negatives(vector_frame(spark, data + twice)) == want
    assert got_negatives(vector_frame(spark, [])) == []
    assert got_negatives(vector_frame(spark, [(0, 1, [1])])) == []


def test_large_components_are_exact(spark):
    top = negatives.LIMIT
    data = [(i, i % 2, [top - i, top - 3 * i, -i]) for i in range(24)]
    want = plain_negatives({i: (lab, v) for i, lab, v in data}, lambda i: i % 4 == 0)
    assert got_negatives(vector_frame(spark, data)) == want


def test_pruning_leaves_no_row_out():
    """Every row that reaches the needed score is among the feasible ones, and some others are not."""
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(500, 10)) * 100).astype("<i4")
    orders = np.argsort(negatives._units(x), axis=0, kind="stable").T.astype("<u2")
    bucket, pruned = negatives.Bucket(np.arange(500), np.zeros(500), x, orders), 0
    for q in (rng.normal(size=(30, 10)) * 100).astype(int):
        anchor = negatives.Anchor(-1, 0, q, [])
        scores = x.astype(int) @ q
        for share in (0.2, 0.6, 0.95, 1.0, 1.5):
            needed = float(scores.max() * share)
            places = bucket.within(anchor, needed)
            places = np.arange(500) if places is None else places
            assert set(np.flatnonzero(scores >= needed)) <= set(places.tolist())
            pruned += 500 - len(places)
    assert pruned > 10_000


def test_whole_components(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan"), 1.0],), ([None, 1.0],), (None,), ([1e300, -1e300],)], "e array<double>")
    assert [r[0] for r in df.select(negatives.whole("e")).collect()] == [[128, -1], None, None, None, [negatives.LIMIT, -negatives.LIMIT]]


# --- languages ---


def plain_ngrams(text):
    out, chars = [], [" "]
    for c in f" {text.lower()} ":
        if c.isalpha() or chars[-1] != " ":
            chars.append(c if c.isalpha() else " ")
    for n in range(1, language.ORDERS + 1):
        grams = ["".join(chars[k : k + n]) for k in range(len(chars) - n + 1)]
        out += [g for g in grams if g.strip() and not (n == 1 and g == " ")]
    return out


def slots_of(texts, bits):
    slots, rows, has = language.ngrams(texts, bits)
    return [sorted(slots[rows == k].tolist()) for k in range(len(texts))], has


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abCÉ ß1.\nИ語", max_size=12), min_size=1, max_size=4))
def test_ngrams_match_plain_ones(texts):
    got, has = slots_of(texts, 31)
    seen = {}
    for text, slots, letter in zip(texts, got, has):
        assert letter == any(c.isalpha() for c in text)
        grams = plain_ngrams(text) if letter else []
        assert len(slots) == len(grams)
        for other, theirs in seen.items():  # equal n-grams have equal slots, whatever stands around
            assert (sorted(grams) == sorted(other)) == (slots == theirs)
        seen[tuple(grams)] = slots


def two_tongues(n, seed=3):
    a, b, rng = vocabulary(200, 1), ["".join(w) for w in vocabulary(200, 8)], random.Random(seed)
    b = [w.replace("a", "oo").replace("e", "uk") for w in b]
    return [(k, " ".join(rng.choice((a, b)[k % 2]) for _ in range(rng.randint(3, 60))), ("aa", "bb")[k % 2]) for k in range(n)]


def test_languages_of_held_out_texts(spark):
    data = two_tongues(400)
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in data], "doc_id long, text string, lang string, id int, source string, score double")
    model = language.learn(df, F.col("id") % 4 != 2)
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    held = [d for d in data if d[0] % 4 == 2]
    assert sum(got[i].lang_pred == lang for i, _, lang in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == len(data)


def test_language_table_and_posterior_by_hand(spark):
    data = [(0, "ab a", "x"), (1, "b b", "y"), (2, "ba", "x"), (3, None, "x"), (4, "cc", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language.learn(df)
    assert model.names == ["x", "y"] and np.allclose(np.exp(model.priors), [2 / 3, 1 / 3])
    counts = np.zeros((2, 1 << model.bits))
    for _, text, lang in data[:3]:
        for s in slots_of([text], model.bits)[0][0]:
            counts[model.names.index(lang), s] += 1
    want = np.log((counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True))
    assert np.allclose(model.table, want, atol=1e-5)
    logs = model.priors + want[:, slots_of(["abba"], model.bits)[0][0]].sum(axis=1) / language.ORDERS
    p = np.exp(logs - logs.max())
    best, score = model.predict(["abba"])
    assert best[0] == p.argmax() and score[0] == pytest.approx(p.max() / p.sum(), rel=1e-4)


def test_awkward_languages(spark):
    schema = "doc_id long, text string, lang string"
    texts = [(1, None, "aa"), (2, "", "aa"), (3, "12 !? \n", "bb"), (None, "kuk ook", None), (None, "kuk ook", None), (7, "word " * 50_000, None)]
    df = spark.createDataFrame(two_tongues(100) + texts, schema)
    model = language.learn(df)
    got = language.identify(spark.createDataFrame(texts, schema), model).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.score > 0) for r in got)[:3] == [(False, k, "und", False) for k in (1, 2, 3)]
    assert len(got) == 6 and got[3][1:] == got[4][1:]
    nothing = language.learn(spark.createDataFrame([], schema))
    assert {(r.lang_pred, r.score) for r in language.identify(df, nothing).collect()} == {("und", 0.0)}
    assert language.identify(spark.createDataFrame([], schema), model).collect() == []


def test_a_very_long_text_is_scored_in_parts(spark, monkeypatch):
    df = spark.createDataFrame(two_tongues(60), "doc_id long, text string, lang string")
    model = language.learn(df)
    long = " ".join(t for _, t, lang in two_tongues(200, 9) if lang == "bb")
    texts = ["kuk", long, "", long[:50]]
    whole = model.predict(texts)
    monkeypatch.setattr(language.parts, "__defaults__", (400,))
    cut = model.predict(texts)
    assert whole[0].tolist() == cut[0].tolist() and cut[0][1] == 1 and cut[0][2] == -1 and np.allclose(whole[1], cut[1], atol=0.05)
    monkeypatch.undo()
    counted = language.learn(df)
    assert np.array_equal(counted.table, model.table)


def test_many_languages_narrow_the_slots(spark):
    df = spark.createDataFrame([(k, f"text{k}", f"l{k}") for k in range(300)], "doc_id long, text string, lang string")
    model = language.learn(df)
    assert len(model.names) == 300 and model.table.size <= language.CELLS


# --- periodic runs ---


def plain_runs(words, least=12):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            if words[s] != words[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            size = e + q - s
            if size >= max(least, 2 * q) and not any(words[s : s + size - z] == words[s + z : s + size] for z in range(1, q)):
                out.append((s, size, q))
            s = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


words_strategy = st.one_of(
    st.lists(st.sampled_from("ab"), max_size=50),
    st.lists(st.sampled_from("abcdef"), max_size=40),
    st.builds(lambda x, y, k, t: y + x * k + x[:t] + y, st.lists(st.sampled_from("abcdefg"), min_size=1, max_size=9),
              st.lists(st.sampled_from("abcdefg"), max_size=9), st.integers(1, 6), st.integers(0, 8)),
)


@settings(max_examples=300, deadline=None)
@given(words_strategy, st.sampled_from([2, 3, 7, 12]))
def test_runs_match_plain_ones(words, least):
    want = plain_runs(words, least)
    assert periodic.runs(words, least) == want
    import pyarrow as pa

    texts = pa.array(["x y", " ".join(words), " ".join(words[::-1])])
    found = periodic._runs_of(texts, least)  # with the stretches that can't hold runs left out
    assert sorted(found.get(1, []), key=lambda r: (r[0], r[2])) == want
    assert sorted(found.get(2, []), key=lambda r: (r[0], r[2])) == plain_runs(words[::-1], least)


def test_runs_of_documents(spark):
    long_run = " ".join(["one two three"] * 7000)
    data = rows() + [(90, "a " * 30, "a"), (90, "a\n" * 30, "b"), (None, "u v w x y z " * 3, "c"), (91, long_run, "d"), (92, "q " * 11, "d")]
    got = periodic.periodic_runs(frame(spark, data)).collect()
    want = []
    for i, text, _ in data:
        words = WORD.findall(text or "")
        found = plain_runs(words) if len(words) < 1000 else [(0, 21000, 3)] if i == 91 else []
        want.append((str(i), len(words), found, plain_collapsed(words, found)))
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)
    assert periodic.periodic_runs(frame(spark, [])).collect() == []
    with pytest.raises(ValueError, match="two words"):
        periodic.periodic_runs(frame(spark, []), least=1)


def test_long_periodic_text_takes_linear_steps():
    """Splay steps per word stay few on texts whose suffixes all repeat."""
    for words in ([1] * 4000, [k % 571 for k in range(4000)]):
        ends, steps = periodic.LastEnds(), 0
        for w in words:
            steps += len(ends.append(w))
        assert steps < 40 * len(words)


def test_query_alters_and_digests(spark, tmp_path):
    rng, words = random.Random(4), vocabulary(60, 3)
    data = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) + rng.choice(["", "\n", "\t"])) for i in range(120)]
    data += [(500, None), (None, "w " * 20), (501, "é " * 20)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.QUERIES["op13_automaton_runs"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, text in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        if i is not None and h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = plain_runs(w)
        s, size, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in found), plain_collapsed(w, found))]
        want.append((i, len(found), s, size, q, 1000 * size // q if found else None, *digest))
    assert got == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 5
