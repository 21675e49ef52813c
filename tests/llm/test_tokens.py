"""Token encoding, grammar files and packing against the tokenizers library itself."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import frame, rows
from tokenizers import Tokenizer

from vitalis.llm import packing, repair
from vitalis.llm.tokens import Encoder, with_end
from vitalis.session import scratch_path

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
TRICKY = [
    "", " ", "a  b", "a  b c", "x  y", "á e ́x", "日本 語 a", "　 a", "tab\t b  c", " lead", "trail ", "a \n b",
    "don't 's 've' it's", "a\nb\n\nc \n.x", "é,à§,÷.×! A\n\tb", "x  y q  r", "<|endoftext|> a <|startoftext|>", "Σας Σ 12345 6,7.8",
]


def ids_of(file, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("file", FILES)
def test_encoder_equals_the_library(file):
    texts = TRICKY + [t for _, t, _ in rows() if t]
    ids, offsets = Encoder(public_tokenizers.path(file), most=50).encode(pa.array(texts))
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == ids_of(file, text), text[:40]


def test_encoder_on_random_text():
    import random

    rng = random.Random(3)
    texts = ["".join(rng.choice(" \n\t  ab'.,!é§日Ж1 ś") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for file in FILES:
        ids, offsets = Encoder(public_tokenizers.path(file)).encode(pa.array(texts))
        for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
            assert ids[a:b].tolist() == ids_of(file, text), repr(text)


@pytest.mark.parametrize("file", FILES)
def test_plain_words_are_encoded_together(file):
    """New words of plain letters go through the library as one text, the others one by one; each has its own ids."""

    class Counted:
        def __init__(self, inner):
            self.inner, self.alone = inner, 0

        def encode_batch(self, parts, **kwargs):
            self.alone += sum(map(len, parts))
            return self.inner.encode_batch(parts, **kwargs)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    encoder = Encoder(public_tokenizers.path(file))
    encoder.tokenizer = Counted(encoder.tokenizer)
    words = [f"{a}{b}{c}" for a in "ÀÿßAzéñÖ" for b in ("ub", "ÇÉ", "qx", "the") for c in ("", "ung", "xqzj")] * 40
    for texts in (["x " + " ".join(words)], ["x " + " ".join(w + "ly" for w in words) + " İx ŉ x̀ ١٢ 12 ª"]):
        ids, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == ids_of(file, texts[0])
    assert encoder.tokenizer.alone <= 10


@pytest.mark.parametrize("file", FILES)
def test_known_stretches_keep_their_codes(file):
    encoder = Encoder(public_tokenizers.path(file))
    first, _ = encoder.encode(pa.array(["red fox, blue fox", "x 12 é\u0301"]))
    known = encoder.known.to_pylist()
    assert len(set(known)) == len(known) == len(encoder.first) - 1
    again, _ = encoder.encode(pa.array(["red owl", "red fox, blue fox", "x 12 é\u0301"]))
    assert encoder.known.to_pylist() == [*known, " owl"] and again.tolist() == ids_of(file, "red owl") + first.tolist()


def test_a_pair_counts_at_the_place_that_stands_for_it():
    left, right = np.array([1, 2, 1, 2, 1, 3], np.uint32), np.array([2, 1, 2, 1, 2, 9], np.uint32)
    best, own, same = repair._frequent(left, right, 2, 10)
    assert own.dtype == np.intp and same.all()
    assert [(left[k], right[k]) for k in best] == [(1, 2), (2, 1)] and (own[best] == best).all()


@pytest.mark.parametrize("ids", [[0], [0, 0, 0, 0], [5] * 5000 + [0], [1, 2, 1, 2, 1, 2] * 900 + [0], list(range(1, 3000)) + [0], [70000, 1] * 500 + [0]])
def test_grammar_round_trip(ids):
    ids = np.array(ids, dtype=np.uint32)
    ends = np.array([len(ids)]) if len(ids) < 5 else np.array([3, len(ids)])
    ids[ends - 1] = 0
    counts = np.diff(np.r_[0, ends])
    block = repair.Block(repair.pack(np.arange(len(ends)), np.ones(len(ends), bool), counts, repair.compress(ids, ends, least=2), 0))
    assert (block.ids() == ids).all()
    begin = 0
    for k, n in enumerate(counts):
        assert (block.document(k) == ids[begin : begin + n]).all()  # random access
        begin += n
    assert block.lengths.sum() == 0 or block.lengths.min() >= 2


def test_grammar_compresses():
    ids = np.tile(np.arange(1, 60, dtype=np.uint32), 400)
    ids[-1] = 0
    grammar = repair.compress(ids, np.array([len(ids)]))
    assert len(grammar["symbols"]) < len(ids) / 20


def test_grammar_files(spark):
    data = rows() + [(None, "no id", "a"), (5, "again", "a")]
    path = scratch_path(spark, "grammar")
    repair.write_grammar(frame(spark, data), path, public_tokenizers.path(FILES[0]), 0, block_tokens=5000)
    whole = repair.read_grammar(spark, path).orderBy("start").collect()
    digests = repair.read_digests(spark, path).orderBy("start").collect()
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for (doc, text, _), got, short in zip(want, whole, digests, strict=True):
        ids = ids_of(FILES[0], text) + [0]
        assert (got["doc_id"], got["start"], got["n_tokens"], got["ids"]) == (doc, start, len(ids), ids)
        assert short["ids_crc32"] == crc(ids)
        start += len(ids)


def test_grammar_of_empty_table(spark):
    path = scratch_path(spark, "grammar")
    repair.write_grammar(frame(spark, []), path, public_tokenizers.path(FILES[0]), 0)
    assert repair.read_digests(spark, path).collect() == []


@pytest.mark.parametrize("open_windows", [1, 3, 64])
def test_packing_holds_every_id_once(spark, open_windows):
    data = rows() + [(100, "twice the same", "a"), (None, "no id", "b")]
    size = 128
    got = packing.pack_documents(
        frame(spark, data).repartition(3), public_tokenizers.path(FILES[1]), 1, size=size, open_windows=open_windows, merge=2
    ).collect()
    ids = {doc: ids_of(FILES[1], text) + [1] for doc, text, _ in data}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and r["length"] > 0
        assert r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, all_ids in ids.items():
        at = 0
        for start, n in sorted(pieces[doc]):
            assert start == at
            at += n
        assert at == len(all_ids)
    padded = 0
    for placed in sequences.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= size
        padded += size - at
    assert padded <= 0.05 * size * len(sequences) + 2 * open_windows * size


def test_packing_repeated_rows_and_empty_table(spark):
    path = public_tokenizers.path(FILES[1])
    twice = packing.pack_documents(frame(spark, [(1, "same text here", "a")] * 2), path, 1, size=64).collect()
    assert sorted((r["doc_id"], r["offset"]) for r in twice) == [(1, 0), (1, twice[0]["doc_tokens"])]
    assert packing.pack_documents(frame(spark, []), path, 1).collect() == []


def test_windows_fill_best_and_emit_fullest():
    w = packing.Windows(size=10, most=2, first=0, least_head=1)
    ids = np.arange(100, dtype=np.uint32)
    w.add(1, 0, ids[:7], 7)  # window 0, gap 3
    w.add(2, 0, ids[:8], 8)  # fits in none: window 1, gap 2
    w.add(3, 0, ids[:2], 2)  # best fit is the smaller gap
    assert [r[0] for r in w.rows] == [2, 3] and w.gaps == [(3, 0)]
    w.add(4, 0, ids[:6], 6)  # window 2
    w.add(5, 0, ids[:9], 9)  # none fits and no window is free: the fullest takes the head and goes
    assert [r[0] for r in w.rows[2:]] == [1, 5] and w.rows[-1][2] == 3


def test_with_end():
    ids, offsets = with_end(np.array([4, 5, 6], dtype=np.uint32), np.array([0, 2, 2, 3]), 9)
    assert ids.tolist() == [4, 5, 9, 9, 6, 9] and offsets.tolist() == [0, 3, 4, 6]


def test_documents_read_by_id(spark, tmp_path):
    """Blocks tell which ids they can hold; a hot id and null ids are spread over shards and come back whole."""
    data = rows() + [(7, f"one hot id {k}", "a") for k in range(400)] + [(None, f"no id {k}", "a") for k in range(100)]
    path = str(tmp_path / "grammar")
    repair.write_grammar(frame(spark, data), path, public_tokenizers.path(FILES[0]), end_id=0, block_tokens=500)
    whole = repair.read_grammar(spark, path).collect()
    assert len(whole) == len(data)
    wanted = [0, 7, 14, 123456]
    got = repair.read_documents(spark, path, wanted).collect()
    key = lambda r: (r[0], list(r[1]))
    assert sorted(map(key, got)) == sorted(key((r["doc_id"], r["ids"])) for r in whole if r["doc_id"] in wanted)
    blocks = spark.read.parquet(path)
    assert blocks.filter("low <= 7 AND high >= 7").select("shard").distinct().count() > 1
    assert repair.read_documents(spark, path, []).collect() == []


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 40, 6000).astype(np.uint32)
    ends = np.r_[np.arange(300, 6000, 300), 6000]
    grammar = repair.compress(ids, ends, least=8, worth=0)
    symbols = grammar["symbols"].astype(np.int64)
    pairs = symbols[:-1] * (1 << 20) + symbols[1:]
    inside = (symbols[:-1] != grammar["stop"]) & (symbols[1:] != grammar["stop"])
    assert np.unique(pairs[inside], return_counts=True)[1].max() < 2 * 8  # runs of one symbol count half their places
