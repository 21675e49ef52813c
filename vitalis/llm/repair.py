"""Token ids as Re-Pair grammars: files of blocks, each a set of pair rules and a short sequence.

A block holds the ids of consecutive documents. Frequent pairs of neighbouring ids become rules,
round after round; a rule names two symbols and knows how many ids it stands for. The end of a
document is a symbol of its own that no rule holds, so one document is decoded from its own
symbols alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, ragged, slices, width, write
from vitalis.llm.tokens import SLICE, Encoder, with_end

_HEAD = struct.Struct("<4sIIIIQII")
_MAGIC = b"RPR1"


def _take(flags: np.ndarray) -> np.ndarray:
    """From runs of neighbouring marked places, every second one, the first included."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at
    first = np.r_[True, np.diff(at) > 1]
    begin = at[first][np.cumsum(first) - 1]
    return at[(at - begin) % 2 == 0]


def _frequent(left: np.ndarray, right: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs seen at least ``least`` times, the most frequent first, and a table from hash to pair.

    Each slot of the table stands for one of the pairs that hash to it; another frequent pair of
    the same slot has its turn in a later round.
    """
    bits = max(10, int(len(left)).bit_length())
    slot = ((left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)).astype(np.intp)
    one = np.zeros(1 << bits, dtype=np.int32)
    one[slot] = np.arange(len(slot), dtype=np.int32)
    own = one.take(slot).astype(np.intp)  # the kind of number that indexes without a copy
    same = (left.take(own) == left) & (right.take(own) == right)
    count = np.bincount(own[same], minlength=len(left))  # a pair counts at the place that stands for it
    best = np.flatnonzero(count >= least)
    best = best[np.argsort(-count[best], kind="stable")][:most]
    return best, own, same


def compress(ids: np.ndarray, ends: np.ndarray, least: int = 8, worth: float = 0.01) -> dict[str, np.ndarray]:
    """Grammar of ``ids``; ``ends`` are the places just after each document's last id.

    Rounds replace pairs seen ``least`` times or more, the most frequent first, until there are none or
    no numbers for rules are left: all symbols stay below 65,536 where the ids leave room for rules, else they
    take 32 bits and there are 2^20 rules at most. A rule costs as much as six symbols, so rarer pairs don't pay. A
    round that replaces less than ``worth`` of the symbols is the last; 0 goes on to the end, for 0.4 % fewer symbols.
    """
    stop = int(ids.max()) + 1 if len(ids) else 1
    room = 65_536 - stop - 1
    room = room if room >= 4_096 else 1 << 20
    symbols = ids.astype(np.uint32)
    symbols[ends - 1] = stop  # each document has an end id, which the reader knows
    rules: list[np.ndarray] = []
    made, base = 0, stop + 1
    while made < room and len(symbols) > 1:
        left, right = symbols[:-1], symbols[1:]
        best, own, same = _frequent(left, right, least, min(room - made, max(256, room // 4)))
        best = best[(left[best] != stop) & (right[best] != stop)]
        if not len(best):
            break
        rule_of = np.full(len(left), -1, dtype=np.int32)
        rule_of[best] = np.arange(len(best), dtype=np.int32)
        rule = rule_of.take(own)
        at = _take((rule >= 0) & same)
        rules.append(np.stack([left[best], right[best]], axis=1))
        symbols[at] = (base + made + rule[at]).astype(np.uint32)
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        made += len(best)
        if len(at) < worth * len(symbols):
            break
    table = np.concatenate(rules).astype(np.int64) if rules else np.zeros((0, 2), dtype=np.int64)
    length = np.ones(base + made, dtype=np.int64)
    first = base
    for part in rules:  # a rule's parts are ids or rules of earlier rounds
        length[first : first + len(part)] = length[part.astype(np.int64)].sum(axis=1)
        first += len(part)
    stops = np.flatnonzero(symbols == stop)
    return {"stop": stop, "rules": table, "lengths": length[base:], "symbols": symbols, "stops": stops}


def pack(doc_ids: np.ndarray, known: np.ndarray, tokens: np.ndarray, grammar: dict, end_id: int) -> bytes:
    """One block: head, documents (id, whether it is not null, ids, symbols before), rules, symbols."""
    wide = grammar["stop"] + 1 + len(grammar["rules"]) > 65_536
    symbols = grammar["symbols"].astype("<u4" if wide else "<u2").tobytes()
    n = len(doc_ids)
    head = _HEAD.pack(
        _MAGIC, n, len(grammar["rules"]), len(grammar["symbols"]), grammar["stop"], int(tokens.sum()), end_id, wide
    )
    before = np.r_[0, grammar["stops"][:-1] + 1] if n else np.zeros(0)
    parts = (doc_ids.astype("<i8"), tokens.astype("<u8"), before.astype("<u8"), grammar["lengths"].astype("<u4"))
    parts += (grammar["rules"].astype("<u4"), known.astype("u1"))
    return head + b"".join(x.tobytes() for x in parts) + symbols


class Block:
    """A block read from its bytes."""

    def __init__(self, data: bytes):
        magic, n, n_rules, n_symbols, self.stop, _, self.end_id, wide = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a grammar block")
        at = _HEAD.size

        def read(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.tokens, self.before = read("<i8", n), read("<u8", n), read("<u8", n).astype(np.int64)
        self.lengths, self.rules = read("<u4", n_rules).astype(np.int64), read("<u4", 2 * n_rules).reshape(-1, 2)
        self.known = read("u1", n).astype(bool)
        self.symbols = read("<u4" if wide else "<u2", n_symbols)
        self._pool: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def _expanded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of every symbol in one array, where each begins, and how many it has."""
        if self._pool is None:
            base = self.stop + 1
            length = np.concatenate([np.ones(base, dtype=np.int64), self.lengths])
            first = np.cumsum(length) - length
            pool = np.empty(int(length.sum()), dtype=np.uint32)
            pool[: self.stop], pool[self.stop] = np.arange(self.stop), self.end_id
            for r, (a, b) in enumerate(self.rules.tolist()):
                at, mid, end = first[base + r], first[base + r] + length[a], first[base + r] + length[base + r]
                pool[at:mid] = pool[first[a] : first[a] + length[a]]
                pool[mid:end] = pool[first[b] : first[b] + length[b]]
            self._pool = pool, first, length
        return self._pool

    def ids(self) -> np.ndarray:
        """Ids of all documents, one after the other."""
        pool, first, length = self._expanded()
        symbols = self.symbols.astype(np.int64)
        return pool[ragged(first[symbols], length[symbols])]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its own symbols and the rules they lead to only."""
        past = int(self.before[k + 1]) if k + 1 < len(self.before) else len(self.symbols)
        out = np.empty(int(self.tokens[k]), dtype=np.uint32)
        base, at, lengths = self.stop + 1, 0, self.lengths
        for symbol in self.symbols[self.before[k] : past].tolist():
            stack = [(symbol, at)]  # a rule's length says where its second half begins
            while stack:
                s, place = stack.pop()
                if s < base:
                    out[place] = self.end_id if s == self.stop else s
                    continue
                a, b = self.rules[s - base].tolist()
                half = 1 if a < base else int(lengths[a - base])
                stack += [(a, place), (b, place + half)]
            at += 1 if symbol < base else int(lengths[symbol - base])
        return out


def write_grammar(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    block_tokens: int = 1 << 19,
) -> None:
    """Encode all texts and write them as grammar blocks below ``path``, in ascending id order.

    Range partitions make the shards; a shard's blocks are numbered and know how many ids of the
    shard stand before them. A null text counts as empty and still has its end id. Documents of
    equal id follow each other by their texts' hashes; a null id comes first. An empty table makes no block. A
    document is never split over blocks; a block ends with the document that reaches
    ``block_tokens``. Other columns don't matter.
    """
    spark = docs.sparkSession
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ("id", F.xxhash64("text"))  # an id of very many rows is cut into several ranges
    slim = slim.repartitionByRange(width(spark), *order).sortWithinPartitions(*order, "text")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = Encoder.of(tokenizer), TaskContext.get().partitionId()
        held, have, block, before = [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, have, block, before
            ids, counts, names, known = (np.concatenate(x) for x in zip(*held))
            payload = pack(names, known, counts, compress(ids, np.cumsum(counts)), end_id)
            row = {"shard": [number], "block": [block], "before": [before], "tokens": [len(ids)], "payload": [payload]}
            some = names[known]
            row |= {"low": [some.min() if len(some) else None], "high": [some.max() if len(some) else None]}
            held, have, block, before = [], 0, block + 1, before + len(ids)
            return pa.RecordBatch.from_pydict(row, schema=_BLOCKS)

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, offsets = with_end(*encoder.encode(part.column(1)), end_id)
                named = part.column(0)
                names, known = np.asarray(named.fill_null(0)), np.asarray(named.is_valid())
                first = 0
                while first < part.num_rows:
                    past = int(np.searchsorted(offsets, offsets[first] + block_tokens - have)) if have < block_tokens else first
                    past = min(max(past, first + 1), part.num_rows)
                    held.append((ids[offsets[first] : offsets[past]], np.diff(offsets[first : past + 1]), names[first:past], known[first:past]))
                    have += offsets[past] - offsets[first]
                    first = past
                    if have >= block_tokens:
                        yield close()
        if held:
            yield close()

    write(slim.mapInArrow(shard, "shard int, block int, before long, tokens long, payload binary, low long, high long"), path)


_BLOCKS = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("tokens", pa.int64()), ("payload", pa.binary()), ("low", pa.int64()), ("high", pa.int64())]
)


def read_grammar(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: id, ``start`` (ids before it in all documents), ids.

    Only one number for each shard (a partition of the write) visits the driver.
    """
    return _decoded(spark, path, lambda ids: ids, pa.list_(pa.uint32()), "ids", "array<long>")


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents with some ids: the files' statistics leave out blocks that can't hold them,
    and of a block only those documents are decoded. Unknown ids have no row; rows that share an id all come."""
    wanted = sorted(set(ids))
    held = F.lit(False)
    for i in wanted:
        held = held | (F.lit(i).between(F.col("low"), F.col("high")))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                block = Block(payload.as_py())
                own = np.flatnonzero(block.known & np.isin(block.doc_ids, wanted))
                columns = [pa.array(block.doc_ids[own]), pa.array([block.document(k) for k in own], type=schema.field(1).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return spark.read.parquet(path).filter(held).select("payload").mapInArrow(decode, "doc_id long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """The same with the number of ids and their CRC-32 instead of the ids."""
    crc = lambda ids: zlib.crc32(ids.astype("<u4").tobytes())
    return _decoded(spark, path, crc, pa.int64(), "ids_crc32", "long")


def _decoded(spark: SparkSession, path: str, what, kind: pa.DataType, name: str, sql: str) -> DataFrame:
    blocks = spark.read.parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("tokens").alias("tokens")).orderBy("shard").collect()
    start, total = {}, 0
    for row in shards:
        start[row["shard"]] = total
        total += row["tokens"]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])
    if pa.types.is_list(kind):
        schema = schema.set(3, pa.field(name, pa.list_(pa.int64())))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, payload in zip(*(batch.column(k) for k in ("shard", "before", "payload"))):
                block = Block(payload.as_py())
                ids, ends = block.ids(), np.cumsum(block.tokens.astype(np.int64))
                begins = ends - block.tokens.astype(np.int64)
                out = [what(ids[a:b]) for a, b in zip(begins, ends)]
                columns = [
                    pa.array(block.doc_ids, mask=~block.known),
                    pa.array(begins + start[shard.as_py()] + before.as_py()),
                    pa.array(ends - begins),
                    pa.array(out, type=schema.field(3).type),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return blocks.select("shard", "before", "payload").mapInArrow(
        decode, f"doc_id long, start long, n_tokens long, {name} {sql}"
    )
