"""Periodic runs of words within a document, by a suffix automaton with link-cut access.

A run is a stretch of words with a smallest period that no neighbouring word extends. Words are
appended to a suffix automaton one after another. Its link tree is kept as preferred paths, one
splay tree each; all states of a path were last met at the same word. Access to the state of the
text so far takes these paths apart from the new state to the root: each cut tells which suffix
occurred last at which earlier end. Where the distance of the two ends is no more than the length
of the suffix, the two occurrences touch, which is a square of that period; it is extended to its run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, mix, slices, text_bytes, window_hashes, word_bounds, word_hashes

_SLICE = 4 << 20  # bytes of text that are hashed at once
_OUT = pa.schema(
    [("id", pa.int64()), ("n_words", pa.int64())]
    + [("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.string())]
)
_COLUMNS = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class LastEnds:
    """Suffix automaton of the words appended so far, with the last end of every state.

    State 0 stands for none, 1 is the empty text. ``up`` is a splay parent inside a preferred path
    and the link to the state above at a path's root; shallower states are to the left. ``end`` is
    valid at roots only and moves with the root.
    """

    def __init__(self) -> None:
        self.steps: list[dict] = [{}, {}]
        self.length, self.link = [0, 0], [0, 0]
        self.up, self.left, self.right, self.end = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.n = 1, 0

    def _state(self, length: int, steps: dict) -> int:
        for column, value in ((self.steps, steps), (self.length, length), (self.link, 0), (self.up, 0)):
            column.append(value)
        for column, value in ((self.left, 0), (self.right, 0), (self.end, -1)):
            column.append(value)
        return len(self.length) - 1

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        up[p], up[x] = x, g
        if left[g] == p and g:
            left[g] = x
        elif right[g] == p and g:
            right[g] = x
        self.end[x] = self.end[p]

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def append(self, word) -> list[tuple[int, int]]:
        """Add a word; (earlier end, longest suffix that ended there last), shorter suffixes later ends' own."""
        steps, length, link = self.steps, self.length, self.link
        new, p = self._state(self.n + 1, {}), self.last
        while p and word not in steps[p]:
            steps[p][word] = new
            p = link[p]
        above = 1
        if p:
            above = q = steps[p][word]
            if length[q] != length[p] + 1:
                above = self._state(length[p] + 1, dict(steps[q]))
                link[above], link[q] = link[q], above
                self._splay(q)  # the copy goes between the state and what is above, on the same path
                over = self.left[above] = self.left[q]
                if over:
                    self.up[over] = above
                self.left[q], self.up[above] = above, q
                while p and steps[p].get(word) == q:
                    steps[p][word] = above
                    p = link[p]
        link[new] = self.up[new] = above
        self.last = new
        found = self._access(new)
        self.n += 1
        return found

    def _access(self, state: int) -> list[tuple[int, int]]:
        up, right, end = self.up, self.right, self.end
        found, below, now = [], 0, state
        while now:
            self._splay(now)
            before, deeper = end[now], right[now]
            if deeper:
                end[deeper] = before
            right[now] = below
            if before >= 0:
                found.append((before, self.length[now]))
            below, now = now, up[now]
        self._splay(state)
        end[state] = self.n
        return found


def runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` words and two periods, by start, then period.

    A square of period d that ends within the run found last for d belongs to it: runs of one
    period overlap in fewer than d words. The suffix tells where the run begins.
    """
    ends, done, out, n = LastEnds(), {}, [], len(words)
    for i, word in enumerate(words):
        for before, length in ends.append(word):
            period = i - before
            if length < period or done.get(period, -1) >= i:
                continue
            start, last = before - length + 1, i
            while last + 1 < n and words[last + 1] == words[last + 1 - period]:
                last += 1
            done[period] = last
            if last - start + 1 >= least:
                out.append((start, last - start + 1, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(words: np.ndarray, first: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Where runs can be: (begin, past) places of stretches that lie within one text each.

    A run of r >= max(least, 2q) words has every word inside a window of half of ``least`` words that occurs
    again q words away, and q is at most half its stretch. All other words are left out.
    """
    size = max(1, least // 2)
    total = len(words) - size + 1
    if total < 2:
        return
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(row[:total] == row[size - 1 :])
    key = window_hashes(words, size)[inside] ^ mix(row[inside].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    gap = np.where(same, inside[order][1:] - inside[order][:-1], len(words))
    near = np.full(len(inside), len(words))
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    again = near < len(words)
    inside, near = inside[again], near[again]
    room = np.diff(first)[row[inside]]
    begin = past = np.zeros(0, dtype=np.int64)
    for _ in range(3):  # shorter stretches leave room for shorter periods only
        ok = 2 * near <= room
        inside, near = inside[ok], near[ok]
        if not len(inside):
            return
        step = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(step, inside, 1)
        np.add.at(step, inside + size, -1)
        covered = np.cumsum(step[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.r_[False, covered, False]))
        begin, past = edge[::2], edge[1::2]
        cuts = first[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(words))]
        cuts = np.unique(cuts[covered[cuts] & covered[cuts - 1]])
        begin, past = np.sort(np.r_[begin, cuts]), np.sort(np.r_[past, cuts])
        room = (past - begin)[np.searchsorted(begin, inside, side="right") - 1]
    for a, b in zip(begin.tolist(), past.tolist()):
        if b - a >= least:
            yield a, b


def _runs_of(texts: pa.Array, least: int) -> dict[int, list[tuple[int, int, int]]]:
    """The runs of each text (no nulls) that has any."""
    data, offsets = text_bytes(texts)
    starts, ends, first = word_bounds(data, offsets)
    words, found = word_hashes(data, starts, ends), {}
    for a, b in stretches(words, first, least):
        text = int(np.searchsorted(first, a, side="right")) - 1
        shift = a - int(first[text])
        own = [(s + shift, n, p) for s, n, p in runs(words[a:b].tolist(), least)]
        if own:
            found.setdefault(text, []).extend(own)
    return found


def _without(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def periodic_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its number of words, its runs, and its text without what runs repeat.

    ``runs`` holds every run of at least ``least`` words (two or more) and two periods, by start, then period;
    ``collapsed`` the words that no run contains after its first period, joined by one space. Words
    are compared by 64-bit hashes within a document. A null or empty text has no words, no runs and
    an empty ``collapsed``. Rows that repeat or share an id, null ids too, are treated each by itself; an
    empty table gives an empty result; other columns don't matter. Nothing is shuffled: a text of
    any length is searched by the task that read it, in memory proportional to its repeated stretches.
    """
    if least < 2:
        raise ValueError("a run has at least two words")
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                found = _runs_of(part.column("text"), least)
                sizes, listed, collapsed = [], [], []
                for k, text in enumerate(part.column("text")):
                    words = text.as_py().encode().split()  # bytes split at space and 9 to 13 only
                    own = sorted(found.get(k, []), key=lambda r: (r[0], r[2]))
                    sizes.append(len(words))
                    listed.append([dict(zip(("start", "length", "period"), r)) for r in own])
                    collapsed.append(b" ".join(_without(words, own) if own else words).decode())
                columns = [part.column("id"), pa.array(sizes, pa.int64()), pa.array(listed, _OUT.field("runs").type), pa.array(collapsed)]
                yield pa.RecordBatch.from_arrays(columns, schema=_OUT)

    return slim.mapInArrow(find, _COLUMNS).select(F.col("id").alias(id_col), "n_words", "runs", "collapsed")
