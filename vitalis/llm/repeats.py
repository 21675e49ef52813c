"""Removal of passages that an earlier document holds, by fixed-block anchors.

Every document's words are cut into non-overlapping reference blocks of 25 words; each repeated
passage of 50 words holds one whole block of its earlier place. Blocks are indexed by hash and
probed with every rolling window of 25 words. Each hit is extended to the windows of 50 words
around it, whose 96-bit hashes are compared; the windows that an earlier document starts are
removed, and overlapping ones merge into maximal repeats.

Work travels as packed arrays: a row holds what a batch of documents sends to one group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, ragged, stage, text_bytes, window_hashes, word_bounds, word_hashes
from vitalis.llm.exchange import groups_for, home_of, ints, read_ints

WINDOW = 50
BLOCK = WINDOW // 2  # a window holds a whole block wherever blocks begin
SALTS = 4  # a block meets the probes of a common passage in so many groups
_SPAN = 2000  # documents packed together

_SENT = pa.schema(
    [("part", pa.int32()), ("salt", pa.int32()), ("kind", pa.int32())]
    + [(c, pa.binary()) for c in ("docs", "counts", "places", "low", "high")]
)
SENT = "part int, salt int, kind int, docs binary, counts binary, places binary, low binary, high binary"
_BACK = pa.schema([("dest", pa.int32())] + [(c, pa.binary()) for c in ("docs", "places", "marks")])
BACK = "dest int, docs binary, places binary, marks binary"
REF, PROBE = 1, 0


def _send(part: np.ndarray, parts: int, salt: int, kind: int, doc: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray):
    """One row for each group: entries by document and place, documents named once."""
    order = np.argsort(part.astype(np.uint16) if parts < 65_536 else part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    doc, place, low, high = doc[order], place[order], low[order], high[order]
    rows = []
    for p in np.flatnonzero(np.diff(bounds)):
        own = slice(bounds[p], bounds[p + 1])
        new = np.flatnonzero(np.r_[True, np.diff(doc[own]) != 0])
        counts = np.diff(np.r_[new, bounds[p + 1] - bounds[p]])
        row = [doc[own][new].astype("<i8").tobytes(), ints(counts), ints(place[own]), low[own].tobytes(), high[own].tobytes()]
        rows += [(int(p), s, kind, *row) for s in ([salt] if kind == PROBE else range(SALTS))]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT)


def _received(table: pa.Table, low: str, high: str) -> tuple[np.ndarray, ...]:
    """Document, place and both hash parts of all entries of some rows."""
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, low), np.zeros(0, high)
    get = {c: table[c].to_pylist() for c in ("docs", "counts", "places", "low", "high")}
    docs = [np.repeat(np.frombuffer(d, "<i8"), read_ints(n)) for d, n in zip(get["docs"], get["counts"])]
    return (
        np.concatenate(docs), np.concatenate([read_ints(x) for x in get["places"]]),
        np.frombuffer(b"".join(get["low"]), low), np.frombuffer(b"".join(get["high"]), high),
    )


def _reply(doc: np.ndarray, place: np.ndarray, mark: np.ndarray, homes: int) -> pa.Table:
    home = home_of(doc, homes)
    order = np.lexsort((place, doc, home))
    home, doc, place, mark = home[order], doc[order], place[order], mark[order]
    bounds = np.searchsorted(home, np.arange(homes + 1))
    own = np.flatnonzero(np.diff(bounds))
    cut = [slice(bounds[h], bounds[h + 1]) for h in own]
    columns = [own.astype(np.int32), [doc[s].tobytes() for s in cut], [place[s].astype("<u4").tobytes() for s in cut], [mark[s].tobytes() for s in cut]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BACK)], schema=_BACK)


def _words(texts: pa.Array, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(texts)
    starts, ends, first = word_bounds(data, offsets)
    return word_hashes(data, starts, ends, seed), first


def _probes(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for k in range(0, batch.num_rows, _SPAN):
                span = batch.slice(k, _SPAN)
                words, first = _words(span.column("text"))
                own = np.flatnonzero(np.diff(first) >= WINDOW)
                n = np.diff(first)[own] - BLOCK + 1
                at = ragged(first[own], n)
                rolled = window_hashes(words, BLOCK)[at] if len(at) else np.zeros(0, np.uint64)
                doc = np.repeat(np.asarray(span.column("id"))[own], n)
                place = at - np.repeat(first[own], n)
                part = ((rolled >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
                low, high = rolled.astype(np.uint32), (rolled >> np.uint64(32)).astype(np.uint8)
                yield from _send(part, parts, number % SALTS, PROBE, doc, place, low, high)
                on = place % BLOCK == 0
                yield from _send(part[on], parts, 0, REF, doc[on], place[on], low[on], high[on])
                number += 1

    return run


def _by_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorting order, the distinct hashes, and where each one's entries begin in that order."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    return order, ordered[first], first


def _anchors(homes: int):
    """Blocks that a later document holds too, and the probes that hit a block of an earlier one."""

    def run(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches), _SENT)
        full = lambda low, high: low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
        ref = got.filter(pa.array(np.asarray(got["kind"]) == REF))
        doc, place, low, high = _received(ref, "<u4", "u1")
        order, known, first = _by_hash(full(low, high))
        doc, place = doc[order], place[order]
        if not len(known):
            return
        earliest = np.minimum.reduceat(doc, first)
        latest = np.full(len(known), np.iinfo(np.int64).min)
        probes = got.filter(pa.array(np.asarray(got["kind"]) == PROBE))
        for k in range(0, probes.num_rows, 16):
            d, p, low, high = _received(probes.slice(k, 16), "<u4", "u1")
            h = full(low, high)
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[at] == h
            d, p, at = d[hit], p[hit], at[hit]
            np.maximum.at(latest, at, d)
            live = earliest[at] < d
            if live.any():
                yield from _reply(d[live], p[live], np.full(live.sum(), PROBE, np.uint8), homes).to_batches()
        live = doc < np.repeat(latest, np.diff(np.r_[first, len(doc)]))
        if live.any():
            yield from _reply(doc[live], place[live], np.full(live.sum(), REF, np.uint8), homes).to_batches()

    return run


def _marked(table: pa.Table, ids: np.ndarray, lengths: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and mark of the replies that fall into a row's windows. Rows may share an id."""
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)
    doc = np.frombuffer(b"".join(table["docs"].to_pylist()), "<i8")
    place = np.frombuffer(b"".join(table["places"].to_pylist()), "<u4").astype(np.int64)
    mark = np.frombuffer(b"".join(table["marks"].to_pylist()), kind)
    order = np.argsort(ids, kind="stable")
    low, high = (np.searchsorted(ids[order], doc, side=s) for s in ("left", "right"))
    row = order[ragged(low, high - low)]
    place, mark = np.repeat(place, high - low), np.repeat(mark, high - low)
    inside = place < lengths[row]
    return row[inside], place[inside], mark[inside]


def _around(row: np.ndarray, place: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and start of every window of 50 words that holds the 25 words from some place."""
    key = np.unique(row << 32 | place)
    row, place = key >> 32, key & 0xFFFFFFFF
    low, high = np.maximum(place - (WINDOW - BLOCK), 0), np.minimum(place, lengths[row] - WINDOW)
    n = np.maximum(high - low + 1, 0)
    key = np.unique(np.repeat(row, n) << 32 | ragged(low, n))
    return key >> 32, key & 0xFFFFFFFF


def _two_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    (a, first), (b, _) = _words(texts, 1), _words(texts, 2)
    return window_hashes(a, WINDOW), window_hashes(b, WINDOW), first


def _windows(parts: int):
    """Around each hit the hashes of its windows; of reference windows the earliest document's only."""

    def run(key: tuple, docs: pa.Table, hits: pa.Table) -> pa.Table:
        out = []
        for k in range(0, docs.num_rows if hits.num_rows else 0, _SPAN):
            span = docs.slice(k, _SPAN)
            texts, ids = span["text"].combine_chunks(), np.asarray(span["id"])
            one, two, first = _two_hashes(texts)
            lengths = np.diff(first)
            row, place, mark = _marked(hits, ids, lengths, "u1")
            for kind in (PROBE, REF):
                r, at = _around(row[mark == kind], place[mark == kind], lengths)
                h1, h2, doc = one[first[r] + at], (two[first[r] + at] >> np.uint64(32)).astype(np.uint32), ids[r]
                if kind == REF and len(r):
                    order = np.lexsort((doc, h2, h1))
                    a, b = h1[order], h2[order]
                    order = np.sort(order[np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]])
                    h1, h2, doc, at = h1[order], h2[order], doc[order], np.zeros(len(order), np.int64)
                part = ((h1 >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
                out += _send(part, parts, key[0].as_py() % SALTS, kind, doc, at, h1, h2)
        return pa.Table.from_batches(out, _SENT)

    return run


def _earlier(homes: int):
    """The probing windows whose words an earlier document has as a window."""

    def run(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches), _SENT)
        kind = np.asarray(got["kind"])
        doc, _, h1, h2 = _received(got.filter(pa.array(kind == REF)), "<u8", "<u4")
        order = np.lexsort((doc, h2, h1))
        doc, h1, h2 = doc[order], h1[order], h2[order]
        if not len(doc):
            return
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        doc, h1, h2 = doc[new], h1[new], h2[new]
        probes = got.filter(pa.array(kind == PROBE))
        for k in range(0, probes.num_rows, 64):
            d, p, a, b = _received(probes.slice(k, 64), "<u8", "<u4")
            at = np.searchsorted(h1, a)
            gone = np.zeros(len(d), dtype=bool)
            for step in range(4):  # equal first hashes are next to each other and rare
                i = np.minimum(at + step, len(h1) - 1)
                gone |= (h1[i] == a) & (h2[i] == b) & (doc[i] < d)
            if gone.any():
                yield from _reply(d[gone], p[gone], a[gone], homes).to_batches()

    return run


_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept", pa.binary())])


def _cut(key: tuple, docs: pa.Table, gone: pa.Table) -> pa.Table:
    out = []
    for k in range(0, docs.num_rows, _SPAN):
        span = docs.slice(k, _SPAN)
        texts, ids = span["text"].combine_chunks(), np.asarray(span["id"].fill_null(0))
        named = np.asarray(span["id"].is_valid())
        spans: dict[int, list[tuple[int, int]]] = {}
        if gone.num_rows:
            one, first = _words(texts)
            lengths = np.where(named, np.diff(first), 0)
            row, place, mark = _marked(gone, ids, lengths - WINDOW + 1, "<u8")
            hashed = window_hashes(one, WINDOW)
            same = hashed[first[row] + place] == mark if len(row) else np.zeros(0, bool)
            at = np.unique(row[same] << 32 | place[same])
            row, place = at >> 32, at & 0xFFFFFFFF
            begins = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (place[1:] > place[:-1] + WINDOW)]) if len(row) else []
            for a, b in zip(begins, [*begins[1:], len(row)]):
                spans.setdefault(int(row[a]), []).append((int(place[a]), int(place[b - 1]) + WINDOW))
        n_words, kept = [], []
        for i, text in enumerate(texts.to_pylist()):
            words = text.encode().split()
            n_words.append(len(words))
            for a, b in reversed(spans.get(i, [])):
                del words[a:b]
            kept.append(b" ".join(words))
        flat = [[x for ab in spans.get(i, []) for x in ab] for i in range(len(kept))]
        columns = [span["id"].combine_chunks(), pa.array(n_words), pa.array(flat, pa.list_(pa.int64())), pa.array(kept, pa.binary())]
        out.append(pa.RecordBatch.from_arrays(columns, schema=_OUT))
    return pa.Table.from_batches(out, _OUT)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per document its number of words, the removed spans and the kept words.

    A word goes if a window of 50 words over it also starts in a document with a smaller id.
    ``spans`` lists start and end word of each maximal removed stretch, one after the other;
    ``kept_text`` joins the kept words by single spaces (with ``digest`` only its SHA-256).
    Null texts have no words. Rows that share an id don't remove each other's words; a row without
    id neither removes nor loses any. An empty table gives an empty result; other columns don't
    matter.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    named = slim.filter("id IS NOT NULL")
    groups = groups_for(docs)
    homes = groups | 1
    sent = named.mapInArrow(_probes(groups), SENT)
    hits = stage(sent.groupBy("part", "salt").applyInArrow(_anchors(homes), BACK), "anchors")
    home = F.coalesce(home_of(F.col("id"), homes), F.lit(0))
    by_home = named.withColumn("dest", home).groupBy("dest")
    sent = by_home.cogroup(hits.groupBy("dest")).applyInArrow(_windows(groups), SENT)
    gone = stage(sent.groupBy("part", "salt").applyInArrow(_earlier(homes), BACK), "repeats")
    by_home = slim.withColumn("dest", home).groupBy("dest")
    shape = "id long, n_words long, spans array<long>, kept binary"
    out = by_home.cogroup(gone.groupBy("dest")).applyInArrow(_cut_digest if digest else _cut, shape)
    removed = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    kept = F.lower(F.hex("kept")).alias("kept_sha256") if digest else F.decode("kept", "UTF-8").alias("kept_text")
    return out.select(F.col("id").alias(id_col), "n_words", removed.alias("n_removed"), kept, "spans")


def _cut_digest(key: tuple, docs: pa.Table, gone: pa.Table) -> pa.Table:
    out = _cut(key, docs, gone)
    kept = pa.array([hashlib.sha256(x.as_buffer()).digest() for x in out["kept"]], pa.binary())
    return out.set_column(3, _OUT.field(3), kept)
