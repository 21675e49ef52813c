"""A hierarchical Pitman-Yor language model: one restaurant for each previous word, one root.

Customers of a context's restaurant are the words seen after it; each table sends one customer to
the root, whose tables draw from a uniform base over the known words and one for all others. The
seating is sampled in rounds: all dishes are reseated customer by customer given the totals of the
round before, and the averaged table counts make the predictive probabilities.

Documents are held in chunks: every chunk keeps its words as indices of its own vocabulary, asks
the owners of words and word pairs for their counts in all documents, and gets them back. What a
hot word or pair sends is one number for each chunk. Pseudo-random numbers come from the pair's
hash, so that all chunks that hold a pair seat it alike without exchanging tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, lower_ascii, mix, stage, text_bytes, word_bounds, word_hashes
from vitalis.llm.exchange import groups_for, home_of, ints, read_ints, squeeze, unsqueeze

_ODD = np.uint64(0x9E3779B97F4A7C15)
END, BEGIN = mix(np.array([3, 5], dtype=np.uint64))
STRENGTH, ROOT_STRENGTH = 1.0, 1.0
SAMPLES = 4
HELD_OUT = 10  # one document in so many, by its id's checksum, is not learned from
WORDS, PAIRS, TABLES = 0, 1, 2

CHUNK = "dest int, ids binary, named binary, learned binary, lengths binary, vocabulary binary, tokens binary"
_CHUNK = pa.schema([("dest", pa.int32())] + [(c, pa.binary()) for c in ("ids", "named", "learned", "lengths", "vocabulary", "tokens")])
ASK = "kind int, part int, dest int, low binary, high binary, first binary, second binary"
_ASK = pa.schema([(c, pa.int32()) for c in ("kind", "part", "dest")] + [(c, pa.binary()) for c in ("low", "high", "first", "second")])
ANSWER = "kind int, part int, dest int, first binary, second binary, s1 double, s2 double, s3 double, s4 double"
_ANSWER = pa.schema(
    [(c, pa.int32()) for c in ("kind", "part", "dest")] + [(c, pa.binary()) for c in ("first", "second")]
    + [(c, pa.float64()) for c in ("s1", "s2", "s3", "s4")]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _pack_chunk(key: tuple, docs: pa.Table) -> pa.Table:
    texts, ids = docs["text"].combine_chunks(), docs["id"].combine_chunks()
    data, offsets = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = word_bounds(data, offsets)
    n = len(texts)
    tokens = np.full(len(starts) + n, END, dtype=np.uint64)
    tokens[np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(first))] = word_hashes(data, starts, ends)
    vocabulary, index, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")  # small numbers for frequent words
    place = np.empty(len(order), dtype=np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    learned = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % HELD_OUT != 0 for i in ids.to_pylist()], np.uint8)
    row = (
        key[0].as_py(), np.asarray(ids.fill_null(0)).astype("<i8").tobytes(), np.asarray(ids.is_valid()).astype(np.uint8).tobytes(),
        learned.tobytes(), (np.diff(first) + 1).astype("<u4").tobytes(), vocabulary[order].tobytes(), squeeze(place[index]),
    )
    return _table([row], _CHUNK)


class _Chunk:
    """A chunk's documents, words and distinct pairs, and the order in which it asks about them."""

    def __init__(self, row: dict, parts: int):
        get = lambda c, kind: np.frombuffer(row[c], kind)
        self.dest, self.ids, self.named = row["dest"], get("ids", "<i8"), get("named", "u1").astype(bool)
        self.lengths = get("lengths", "<u4").astype(np.int64)
        self.learned = get("learned", "u1").astype(bool)
        self.words = np.r_[get("vocabulary", "<u8"), BEGIN]
        self.tokens = unsqueeze(row["tokens"], "<u4").astype(np.int64)
        self.parts = parts
        n = len(self.words)
        before = np.r_[n - 1, self.tokens[:-1]]
        before[np.cumsum(self.lengths)[:-1]] = n - 1
        counted = np.repeat(self.learned, self.lengths)
        self.word_counts = np.bincount(self.tokens[counted], minlength=n)
        self.word_counts[-1] = self.learned.sum()  # each learned document has one begin
        pairs, self.pair_of = np.unique(before * n + self.tokens, return_inverse=True)
        self.pair_counts = np.bincount(self.pair_of[counted], minlength=len(pairs))
        self.context, self.word = pairs // n, pairs % n
        self.pairs = mix(self.words[self.context] * _ODD + self.words[self.word])

    def order(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = ((keys >> np.uint64(48)) % np.uint64(self.parts)).astype(np.int64)
        order = np.lexsort((keys, part))
        return order, np.searchsorted(part[order], np.arange(self.parts + 1))

    def ask(self, kind: int, keys: np.ndarray, first: np.ndarray, second: np.ndarray | None = None) -> list[tuple]:
        order, bounds = self.order(keys)
        keys, first = keys[order], first[order]
        second = None if second is None else second[order].astype("<f4")
        rows = []
        for p in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[p], bounds[p + 1])
            high = (keys[own] >> np.uint64(32)).astype("<u4" if kind != PAIRS else "<u2").tobytes()
            one = ints(first[own]) if second is None else first[own].astype("<f4").tobytes()
            two = None if second is None else second[own].tobytes()
            rows.append((kind, int(p), self.dest, keys[own].astype("<u4").tobytes(), high, one, two))
        return rows

    def answers(self, table: pa.Table, kind: int, keys: np.ndarray, read: dict) -> dict[str, np.ndarray]:
        """The answered columns, in the order of ``keys``."""
        order, bounds = self.order(keys)
        out = {c: np.zeros(len(keys)) for c in read}
        for row in table.filter(pa.array(np.asarray(table["kind"]) == kind)).select(["part", *read]).to_pylist():
            own = order[bounds[row["part"]] : bounds[row["part"] + 1]]
            for c, how in read.items():
                out[c][own] = how(row[c], len(own))
        return out


def _keys(rows: list[dict], high: str) -> np.ndarray:
    low = np.frombuffer(b"".join(r["low"] for r in rows), "<u4").astype(np.uint64)
    return low | (np.frombuffer(b"".join(r["high"] for r in rows), high).astype(np.uint64) << np.uint64(32))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, where each key begins, and the key's number of each entry."""
    order = np.argsort(keys, kind="stable")
    new = np.r_[True, keys[order][1:] != keys[order][:-1]]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), number


def _count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answer each chunk with the counts in all documents, and whether it is the pair's first."""
    kind, part = (k.as_py() for k in key)
    rows = sorted(pa.Table.from_batches(list(batches), _ASK).to_pylist(), key=lambda r: r["dest"])
    parts = [read_ints(r["first"]) for r in rows]
    keys, counts = _keys(rows, "<u4" if kind == WORDS else "<u2"), np.concatenate(parts)
    order, first, number = _groups(keys)
    total = np.add.reduceat(counts[order], first)
    chief = np.zeros(len(keys), dtype=bool)
    chief[order[first]] = True  # rows are in order of chunks, and the sort is stable
    whole, out, at = total[number], [], 0
    known = total if kind == PAIRS else total[keys[order[first]] != BEGIN]
    sums = (float(known.sum()), float((known > 0).sum()), float((known == 1).sum()), float((known == 2).sum()))
    out.append((kind, part, -1, None, None, *sums))
    for r, own in zip(rows, parts):
        past = at + len(own)
        out.append((kind, part, r["dest"], ints(whole[at:past]), np.packbits(chief[at:past]).tobytes(), 0.0, 0.0, 0.0, 0.0))
        at = past
    yield from _table(out, _ANSWER).to_batches()


def _salt(*numbers: int) -> np.uint64:
    h = np.array([7], dtype=np.uint64)
    for n in numbers:
        h = mix(h + np.uint64((n + 1) * int(_ODD) % 2**64))
    return h[0]


def seat(counts: np.ndarray, fresh: np.ndarray, discount: float, keys: np.ndarray, sweep: int, samples: int = SAMPLES) -> np.ndarray:
    """Mean number of tables over sampled seatings of ``counts`` customers of each dish.

    Customers come one by one; the next opens a table with weight ``fresh`` and joins one of t
    tables with weight seated - discount * t. From the 16th on they come in blocks of an eighth of
    those seated, with the weights of the block's middle. All dishes go through the same steps, so
    those that still have customers are a prefix once sorted.
    """
    mean = (counts > 0).astype(float)
    several = np.flatnonzero(counts > 1)
    order = several[np.argsort(-counts[several], kind="stable")]
    if not len(order):
        return mean
    c, a, k, total = counts[order], fresh[order], keys[order], np.zeros(len(order))
    falling = -c
    for s in range(samples):
        h, t, seated, step = mix(k ^ _salt(sweep, s)), np.ones(len(c)), 1, 0
        while n := int(np.searchsorted(falling, -seated)):
            size = 1 if seated < 16 else seated // 8
            block = np.minimum(size, c[:n] - seated)
            share = a[:n] / (a[:n] + seated + (block - 1) / 2 - discount * t[:n])
            chance = (((h[:n] ^ _salt(s, step)) * _ODD) >> np.uint64(11)) * 2.0**-53
            t[:n] += np.minimum(np.floor(block * share + chance), block)
            seated, step = seated + size, step + 1
        total += t
    mean[order] = total / samples
    return mean


class _Model:
    """Numbers of the whole corpus that every task needs; all of them are sums."""

    def __init__(self, words: tuple, pairs: tuple):
        self.tokens, self.vocabulary, one, two = words
        clip = lambda a, b: float(np.clip(a / max(1.0, a + 2 * b), 0.1, 0.9))
        self.root_discount, self.discount = clip(one, two), clip(pairs[2], pairs[3])
        self.roots: list[tuple[float, float]] = []  # customers and tables of the root, by round


def _counts(data: bytes, n: int) -> np.ndarray:
    return read_ints(data)


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n)


def _floats(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<f4")


class _State:
    """A chunk with what it was told: counts in all documents, and tables after each round."""

    def __init__(self, chunk: _Chunk, told: pa.Table, model: _Model, rounds: int):
        self.chunk, self.model = chunk, model
        self.word_total = chunk.answers(told, WORDS, chunk.words, {"first": _counts})["first"]
        pair = chunk.answers(told, PAIRS, chunk.pairs, {"first": _counts, "second": _flags})
        self.pair_total, self.chief = pair["first"].astype(np.int64), pair["second"].astype(bool)
        read = {"first": _floats, "second": _floats}
        self.after = [chunk.answers(told, TABLES + r, chunk.words, read) for r in range(rounds)]

    def totals(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        """Tables of each word's restaurant and the root's probability of each word, after round r.

        Before the first round a restaurant of c customers is taken to have c ** discount tables,
        and the root to know the words' shares.
        """
        m = self.model
        if r == 0:
            share = (self.word_total + 0.1) / (m.tokens + 0.1 * (m.vocabulary + 1))
            return self.word_total**m.discount, share
        told = self.after[r - 1]
        customers, tables = m.roots[r - 1]
        fresh = (ROOT_STRENGTH + m.root_discount * tables) / (m.vocabulary + 1)
        root = (np.maximum(told["second"], 0) + fresh) / (ROOT_STRENGTH + customers)
        return told["first"], root

    def tables(self, r: int, own: np.ndarray | None = None) -> np.ndarray:
        """Mean tables of each pair (or of the ``own`` ones) when seated by the totals after round r."""
        open_, root = self.totals(r)
        c, m = self.chunk, self.model
        fresh = (STRENGTH + m.discount * open_[c.context]) * root[c.word]
        counts = self.pair_total if own is None else np.where(own, self.pair_total, 0)
        return seat(counts, fresh, m.discount, c.pairs, r)


def _sweep(parts: int, model: _Model, r: int):
    def run(key: tuple, chunks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in chunks.to_pylist():
            state = _State(_Chunk(row, parts), told, model, r)
            c = state.chunk
            mean = state.tables(r, state.chief)  # of each pair once in all chunks
            by_context = np.bincount(c.context, weights=mean, minlength=len(c.words))
            by_word = np.bincount(c.word, weights=mean, minlength=len(c.words))
            out += c.ask(TABLES + r, c.words, by_context, by_word)
        return _table(out, _ASK)

    return run


def _gather(model: _Model, r: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sum the tables, seat the root's customers, and tell every chunk."""
        kind, part = (k.as_py() for k in key)
        rows = pa.Table.from_batches(list(batches), _ASK).to_pylist()
        one, two = ([np.frombuffer(x[c], "<f4").astype(float) for x in rows] for c in ("first", "second"))
        keys = _keys(rows, "<u4")
        order, first, number = _groups(keys)
        by_context, by_word = (np.add.reduceat(np.concatenate(x)[order], first) for x in (one, two))
        fresh = np.full(len(first), ROOT_STRENGTH / (model.vocabulary + 1) + model.root_discount)
        root = seat(np.rint(by_word).astype(np.int64), fresh, model.root_discount, keys[order[first]], r)
        out, at = [(kind, part, -1, None, None, float(by_word.sum()), float(root.sum()), 0.0, 0.0)], 0
        seated = by_word - model.root_discount * root  # what the root's tables leave of its customers
        columns = [x[number].astype("<f4") for x in (by_context, seated)]
        for x, own in zip(rows, one):
            past = at + len(own)
            out.append((kind, part, x["dest"], *(c[at:past].tobytes() for c in columns), 0.0, 0.0, 0.0, 0.0))
            at = past
        yield from _table(out, _ANSWER).to_batches()

    return run


_SCORES = pa.schema(
    [("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
     ("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(parts: int, model: _Model, rounds: int):
    def run(key: tuple, chunks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in chunks.to_pylist():
            state = _State(_Chunk(row, parts), told, model, rounds)
            c = state.chunk
            open_, root = state.totals(rounds)
            mean = state.tables(rounds - 1)
            seated = state.word_total[c.context]
            rest = (STRENGTH + model.discount * open_[c.context]) / (STRENGTH + seated) * root[c.word]
            own = np.maximum(state.pair_total - model.discount * mean, 0) / (STRENGTH + seated)
            by_pair = np.log10(np.where(seated > 0, own + rest, root[c.word]))
            base = np.log10((state.word_total + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1)))
            first = np.cumsum(c.lengths) - c.lengths
            add = lambda x: np.add.reduceat(x, first)  # noqa: E731  every document has an end
            columns = [
                pa.array(c.ids, mask=~c.named), pa.array(~c.learned), pa.array(c.lengths),
                pa.array(add((state.word_total > 0)[c.tokens].astype(np.int64))), pa.array(np.full(len(c.ids), int(model.tokens))),
                pa.array(add(base[c.tokens])), pa.array(add(by_pair[c.pair_of])),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, schema=_SCORES))
        return pa.Table.from_batches(out, _SCORES)

    return run


def _sums(answers: DataFrame, kind: int) -> tuple:
    row = answers.filter((F.col("dest") == -1) & (F.col("kind") == kind)).agg(*(F.sum(f"s{i}") for i in range(1, 5))).first()
    return tuple(x or 0.0 for x in row)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2) -> DataFrame:
    """Log10 probability of each text under the model and under the smoothed word shares.

    The model learns from the documents whose id's checksum leaves a remainder; words are
    lower-cased A-Z, and each document ends with an end token. Null and empty texts are the end
    alone. Rows that repeat are documents of their own; a null id counts as an empty one (held
    out); an empty table gives an empty result. Other columns don't matter.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = groups_for(docs)
    home = F.coalesce(home_of(F.col("id"), parts | 1), F.lit(0))
    chunks = stage(slim.withColumn("dest", home).groupBy("dest").applyInArrow(_pack_chunk, CHUNK), "chunks")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                c = _Chunk(batch.slice(k, 1).to_pylist()[0], parts)
                rows = c.ask(WORDS, c.words, c.word_counts) + c.ask(PAIRS, c.pairs, c.pair_counts)
                yield from _table(rows, _ASK).to_batches()

    told = stage(chunks.mapInArrow(ask, ASK).groupBy("kind", "part").applyInArrow(_count, ANSWER), "counts")
    model = _Model(_sums(told, WORDS), _sums(told, PAIRS))
    by_chunk = chunks.groupBy("dest")
    for r in range(rounds):
        asked = by_chunk.cogroup(told.filter("dest >= 0").groupBy("dest")).applyInArrow(_sweep(parts, model, r), ASK)
        tables = stage(asked.groupBy("kind", "part").applyInArrow(_gather(model, r), ANSWER), "tables")
        model.roots.append(_sums(tables, TABLES + r)[:2])
        told = told.unionByName(tables)
    shape = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = by_chunk.cogroup(told.filter("dest >= 0").groupBy("dest")).applyInArrow(_score(parts, model, rounds), shape)
    return out.withColumnRenamed("id", id_col)


def perplexity(scores: DataFrame, column: str = "score") -> float | None:
    """Of the held-out documents' tokens."""
    row = scores.filter("held_out").agg(F.sum(column), F.sum("n_tokens")).first()
    return 10 ** (-row[0] / row[1]) if row[1] else None
