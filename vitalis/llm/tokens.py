"""Token ids of whole texts by the tokenizers library, with each distinct stretch encoded once."""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from vitalis.llm.common import ragged, text_bytes

SLICE = 12 << 20  # bytes of texts that are encoded at once


def _plain(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that surely is no white space starts at each place."""
    b = data[at]
    return ((b > 32) & (b < 127)) | ((b >= 0xC3) & (b <= 0xE0)) | ((b >= 0xE4) & (b <= 0xED)) | (b >= 0xF0)


def _plain_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that surely is no white space ends before each place."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    tail, tail2 = (one & 0xC0) == 0x80, (two & 0xC0) == 0x80
    return (
        ((one > 32) & (one < 127))
        | (tail & (two >= 0xC3) & (two <= 0xDF))
        | (tail & tail2 & ((three == 0xE0) | ((three >= 0xE4) & (three <= 0xED))))
    )


def _letter_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether an ASCII letter or an accented Latin-1 letter ends before each place."""
    one, two = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    low = one | 32
    return ((low >= 97) & (low <= 122)) | ((two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7))


#: Classes of bytes: 1 space, 2 line feed, 3 ASCII punctuation, 0 any other.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[32], _CLASS[10] = 1, 2
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3


def stretches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where texts may be cut without changing their ids, the starts of texts included.

    Cuts stand before a single space and around a single line feed between two characters that
    aren't white space, and between a letter and the ASCII punctuation after it. A byte-pair
    tokenizer that first splits letters, punctuation and white space never joins across these.
    """
    kind = _CLASS[data]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    blank = np.flatnonzero((kind == 1) | (kind == 2))
    blank = blank[(blank > 0) & (blank + 1 < len(data))]
    blank = blank[_plain_before(data, blank) & _plain(data, blank + 1)]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    blank = blank[~edge[blank] & ~edge[blank + 1]]
    mark = np.flatnonzero(kind == 3)
    mark = mark[(mark > 0) & ~edge[mark]]
    mark = mark[_letter_before(data, mark)]
    edge[:] = False
    edge[blank] = edge[mark] = edge[starts] = True
    edge[blank[kind[blank] == 2] + 1] = True
    return np.flatnonzero(edge)


#: How texts are first split where a vocabulary marks ends of words: a run of letters is one word.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Ids of Arrow texts. Beyond ``most`` remembered stretches it starts afresh."""

    _shared: dict[str, "Encoder"] = {}

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.most = most
        made, vocab = json.loads(self.tokenizer.to_str()), self.tokenizer.get_vocab()
        numbers = list(vocab.values())
        self.bytes_of: np.ndarray | None = None  # of each id, for byte-level vocabularies
        if made["normalizer"] is None and made["pre_tokenizer"]["type"] == "ByteLevel":
            self.bytes_of = np.zeros(max(numbers) + 1, dtype=np.int64)
            self.bytes_of[numbers] = [len(x) for x in vocab]
        self.ends_word: np.ndarray | None = None  # whether an id ends a word, for vocabularies that mark this
        suffix = made["model"].get("end_of_word_suffix")
        if suffix and any(p.get("pattern") == {"Regex": _WORDS} for p in made["pre_tokenizer"].get("pretokenizers", [])):
            self.ends_word = np.zeros(max(numbers) + 1, dtype=bool)
            self.ends_word[numbers] = [x.endswith(suffix) for x in vocab]
        self._forget()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """One encoder for each vocabulary and worker process, kept from task to task."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())  # distinct stretches; the place of one is its code
        self.pool, self.first = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _joined(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which stretches can be encoded as parts of one text, whose ids tell where each of them ends.

        Each begins with a single space, so nothing is joined across them. With a byte-level vocabulary the ids' bytes
        tell them apart; with one that marks ends of words a stretch has to be one word of plain letters.
        """
        first, past = offsets[:-1], offsets[1:]
        led = (data[first] == 32) & (past - first > 1)
        if self.bytes_of is not None:
            return led & _plain(data, np.minimum(first + 1, len(data) - 1)) & _plain_before(data, past)
        if self.ends_word is None:
            return np.zeros(len(first), dtype=bool)
        low, before = data | 32, np.r_[np.uint8(0), data[:-1]]
        accented = (before == 0xC3) & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        odd = ~(((low >= 97) & (low <= 122) & (data < 128)) | (data == 0xC3) | accented)
        return led & (np.add.reduceat(odd, first, dtype=np.int64) == 1)  # the space

    def _ids_joined(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text of joined stretches that end at such bytes, and their number in each; none if they can't be told apart."""
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        if self.bytes_of is not None:
            return ids, np.diff(np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, side="right"), prepend=0)
        last = np.flatnonzero(self.ends_word[ids])
        return (ids, np.diff(last, prepend=-1)) if len(last) == len(ends) and last[-1] + 1 == len(ids) else None

    def _learn(self, new: pa.Array) -> None:
        """Ids of new stretches, which follow the known ones."""
        data, offsets = text_bytes(new)
        joined = self._joined(data, offsets)
        order = np.argsort(~joined, kind="stable")
        data, offsets = text_bytes(new.take(pa.array(order)))
        ids, counts = [], []
        for first, past, together in ((0, int(joined.sum()), True), (int(joined.sum()), len(new), False)):
            for k in range(first, past, 2048):
                ends = offsets[k : min(past, k + 2048) + 1]
                raw = data[ends[0] : ends[-1]].tobytes()
                made = self._ids_joined(raw.decode(), ends[1:] - ends[0]) if together else None
                if made is None:
                    part = [raw[a:b].decode() for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0])]
                    found = self.tokenizer.encode_batch([part], is_pretokenized=True, add_special_tokens=False)[0]
                    of = np.array([-1 if w is None else w for w in found.word_ids], dtype=np.int64)
                    made = np.array(found.ids, dtype=np.uint32), np.bincount(of[of >= 0], minlength=len(part))
                ids.append(made[0])
                counts.append(made[1])
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        own = np.empty_like(counts)
        own[order] = counts
        begin = np.empty_like(counts)
        begin[order] = np.cumsum(counts) - counts
        self.pool = np.concatenate([self.pool, ids[ragged(begin, own)]])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(own)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no nulls), and the n + 1 places where each text's ids begin."""
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        starts = stretches(data, offsets)
        bounds = np.append(starts, len(data))
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data))
        if len(self.known) > self.most:
            self._forget()
        have = len(self.known)
        coded = pa.chunked_array([self.known, parts] if have else [parts]).dictionary_encode().chunk(int(have > 0))  # known ones keep their codes
        if len(coded.dictionary) > have:
            self._learn(coded.dictionary.slice(have))
            self.known = coded.dictionary
        code = np.asarray(coded.indices).astype(np.int64)
        lengths = self.first[code + 1] - self.first[code]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return self.pool[ragged(self.first[code], lengths)], before[np.searchsorted(starts, offsets)]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one end id after each text."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, dtype=np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
    return out, offsets + np.arange(n + 1)
