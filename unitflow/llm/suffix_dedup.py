"""Removal of repeated 100-byte strings, by a sparse suffix array over anchors.

Anchors. Of the 24-byte grams of each window (100 bytes) the one with the least hash is the window's anchor, so equal windows
have their anchor at the same offset, and the windows of a document fall into runs with one anchor each. An anchor stands for
its run: a suffix that begins with the gram, and the bytes to the left that the run covers. About one position in forty is
an anchor.

First pass. Anchors are range-partitioned by (gram key, class) at sampled splitters; a gram key's leading bits are the gram's
leading bytes, a class is a hash of the run's bytes and extent. Each bucket is sorted. All of a class but the first (by
document, then place) have their whole run earlier in the corpus. Those that are not first among the rows of their own task
are known there, so a very common passage sends one row a task. The first of each class goes on where its gram has several
classes, or may have others beyond a bucket's boundary.

Refining. These suffixes, now with their bytes, are range-partitioned in the same way. A group (a gram's suffixes) that lies
within one bucket and has at most ``group_rows`` rows is sorted by a multikey quicksort over 8-byte words; common prefixes of
neighbours give those of all pairs as running minima, and each pair of an earlier and a later suffix with L common bytes to
the left and R from the gram on, L + R >= 100, covers the later one's [-L, R). A larger group, or one that a bucket boundary
cuts, is refined instead: windows begin 0 to 76 bytes left of the gram; the windows of each half of that range share a longer
string, so each suffix goes to two groups of longer keys, with the bytes that matter there, and suffixes equal in these are
one again. After seven halvings a key is a whole window. So no group is compared as a whole in one task, and a suffix
makes at most two rows a round, most of which are alone in their group and go.

Last pass: documents meet their covered spans, once.
"""

from __future__ import annotations

import gc
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, frugal, hash_sample, quoted, small_batches, written

LENGTH, GRAM = 100, 24
RUN = LENGTH - GRAM + 1
GROUP_ROWS, SAMPLE_ROWS, SLICE, BUCKET_ROWS = 64, 1500, 300_000, 4000
#: Bits below an anchor's place that hold its offset in the run and, LOW bits each, the run's windows less one.
LOW = 7
DEALT = "bucket int, k long, x long, lo int, hi int, d long, th long, a long, off int, data binary"
REFINED = "d long, th long, a long, end long, k long, x long, lo int, hi int, off int, data binary"
_random = np.random.default_rng(20240229)
CODE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = _random.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(ODD[7])
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i below n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def stirred(h: np.ndarray) -> np.ndarray:
    return h ^ (h >> np.uint64(29))


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    h = CODE[b]
    for k, s in enumerate((1, 2, 4, 8)):
        h = stirred(h[:-s] * ODD[k] + h[s:])
    return stirred((h[:-8] * ODD[4] + h[8:]) * ODD[5])


class Places:
    """The anchors of some texts that stand one after the other in ``b``; document i begins at ends[i]."""

    def __init__(self, b: np.ndarray, ends: np.ndarray):
        none = np.zeros(0, np.int64)
        self.at = self.first = self.count = self.doc = none
        self.gram = self.run = np.zeros(0, np.uint64)
        if len(b) < LENGTH:
            return
        h = gram_hashes(b)
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        for s in (1, 2, 4, 8, 16, 32, RUN - 64):
            least = np.minimum(least[:-s], least[s:])
        # a window counts if it lies in one document
        sizes = np.diff(ends)
        last = np.zeros(len(b) + 1, np.int32)
        some = np.flatnonzero(sizes >= LENGTH)
        np.add.at(last, ends[some], 1)
        np.add.at(last, ends[some + 1] - LENGTH + 1, -1)
        starts = np.flatnonzero(np.cumsum(last[: len(least)]))
        if not len(starts):
            return
        anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        self.at, self.first = anchor[edge], starts[edge]
        self.count = np.diff(np.append(edge, len(anchor)))
        self.doc = np.searchsorted(ends, self.first, side="right") - 1
        self.gram = key_of(b, self.at, h[self.at])
        up, down = powers(len(b) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(CODE[b] * up[: len(b)], dtype=np.uint64)])
        end = self.first + self.count - 1 + LENGTH
        self.run = stirred(stirred((total[end] - total[self.first]) * down[self.first]) * ODD[6])

    def classes(self) -> np.ndarray:
        """The class within a gram: a hash of the run's bytes, the offset of the anchor in it, and its extent."""
        low = (self.at - self.first) << LOW | (self.count - 1)
        return stirred((self.run + low.astype(np.uint64) * ODD[3]) * ODD[2])

    def packed(self, places: np.ndarray) -> np.ndarray:
        """Places with offset and extent below."""
        return places << 2 * LOW | (self.at - self.first) << LOW | (self.count - 1)


def key_of(b: np.ndarray, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A gram's key: its three leading bytes, then 40 bits of its hash."""
    lead = b[at].astype(np.uint64) << np.uint64(16) | b[at + 1].astype(np.uint64) << np.uint64(8) | b[at + 2].astype(np.uint64)
    return lead << np.uint64(40) | h >> np.uint64(24)


def unpacked(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, offset of the anchor in its run, windows of the run)"""
    mask = (1 << LOW) - 1
    return a >> 2 * LOW, a >> LOW & mask, (a & mask) + 1


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, far = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > far[:-1]])
    return start[new], far[np.append(np.flatnonzero(new)[1:] - 1, len(far) - 1)]


def texts_in(batch: pa.RecordBatch, col: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about SLICE bytes; a longer text is a stretch of its own."""
    size = pc.binary_length(batch.column(col)).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(size):
        stop = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), SLICE, side="right")))
        yield at, stop
        at = stop


def joined(batch: pa.RecordBatch, col: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    texts = batch.column(col).slice(a, b - a).to_pylist()
    ends = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends


class Splitters:
    """Sampled (key, class) pairs that cut the sorted rows into buckets; they balance the buckets and decide nothing else."""

    def __init__(self, key: np.ndarray, sub: np.ndarray, buckets: int):
        pairs = np.unique(np.stack([key, sub], 1), axis=0) if len(key) else np.zeros((0, 2), np.uint64)
        if len(pairs) > buckets:
            pairs = pairs[np.linspace(0, len(pairs) - 1, buckets + 1).astype(int)[1:-1]]
        self.key, self.sub = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        self.cut = np.unique(self.key)

    def bucket(self, key: np.ndarray, sub: np.ndarray) -> np.ndarray:
        out = np.searchsorted(self.key, key, side="left")
        for i in np.flatnonzero(self.divided(key)).tolist():
            end = np.searchsorted(self.key, key[i], side="right")
            out[i] += np.searchsorted(self.sub[out[i] : end], sub[i], side="right")
        return out.astype(np.int32)

    def divided(self, key: np.ndarray) -> np.ndarray:
        """Whether rows of the key may stand in several buckets."""
        at = np.minimum(np.searchsorted(self.cut, key), max(0, len(self.cut) - 1))
        return self.cut[at] == key if len(self.cut) else np.zeros(len(key), bool)


def anchor_rows(splitters: Splitters):
    """(d, th, t) to rows: anchors that are first among their slice, and merged spans of the others (g null: a to c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in texts_in(batch, 2):
                data, ends = joined(batch, 2, a, b)
                p = Places(data, ends)
                if not len(p.at):
                    continue
                own_d, own_th = d[a:b][p.doc], th[a:b][p.doc]
                place, word = p.packed(p.at - ends[p.doc]), p.classes()
                order = np.lexsort((place, own_th, own_d, word, p.gram))
                same = np.concatenate([[False], (p.gram[order][1:] == p.gram[order][:-1]) & (word[order][1:] == word[order][:-1])])
                # equal rows of one document are the same place, so neither is later
                first = np.flatnonzero(~same)[np.cumsum(~same) - 1]
                tied = (own_d[order] == own_d[order][first]) & (own_th[order] == own_th[order][first]) & (place[order] == place[order][first])
                later = order[same & ~tied]
                rest = order[~same | tied]
                yield rows_of(splitters.bucket(p.gram[rest], word[rest]), p.gram[rest].view(np.int64), word[rest].view(np.int64), own_d[rest], own_th[rest], place[rest], None)
                if len(later):
                    s, e = merged(p.first[later], p.first[later] + p.count[later] - 1 + LENGTH)
                    # merged spans may touch across documents: cut there
                    doc = np.searchsorted(ends, s, side="right") - 1
                    while len(over := np.flatnonzero(e > ends[doc + 1])):
                        s, e = np.append(s, ends[doc + 1][over]), np.append(np.where(e > ends[doc + 1], ends[doc + 1], e), e[over])
                        doc = np.searchsorted(ends, s, side="right") - 1
                    yield rows_of((d[a:b][doc] % (len(splitters.key) + 1)).astype(np.int32), np.zeros(len(s), np.int64), e - ends[doc], d[a:b][doc], th[a:b][doc], s - ends[doc], np.ones(len(s), bool))

    return run


def rows_of(bucket, g, c, d, th, a, null) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(g, mask=null), pa.array(c), pa.array(d), pa.array(th), pa.array(a)], ["bucket", "g", "c", "d", "th", "a"])


def class_firsts(splitters: Splitters):
    """Rows sorted by (g, c, d, th, a) to spans of later members (g null: a to c) and to firsts of classes (g, c, d, th, a) whose gram has several, or is divided.

    Only the open class's first row is kept from one batch to the next.
    """
    names = ["g", "c", "d", "th", "a"]

    def spans(c, d, th, a) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(len(d), pa.int64()), *map(pa.array, (c, d, th, a))], names)

    def firsts(x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(5)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: np.ndarray | None = None  # the open class's first row
        pending = False  # it is the only class of its gram so far, and is not given out
        for batch in batches:
            known = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            cols = [batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(5)]
            if known.any():
                yield spans(*(x[known] for x in cols[1:]))
            rows = np.stack([x[~known] for x in cols], 1)
            if not len(rows):
                continue
            rows = rows if last is None else np.concatenate([last[None], rows])
            head = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])
            place = np.flatnonzero(head)[np.cumsum(head) - 1]
            later = ~head & (rows[:, 2:] != rows[place][:, 2:]).any(1)
            if later.any():
                at, off, n = unpacked(rows[later, 4])
                yield spans(at - off + n - 1 + LENGTH, rows[later, 2], rows[later, 3], at - off)
            own = rows[head]
            edge = np.concatenate([[True], own[1:, 0] != own[:-1, 0]])
            several = np.diff(np.append(np.flatnonzero(edge), len(own))) > 1
            give = several[np.cumsum(edge) - 1] | splitters.divided(np.ascontiguousarray(own[:, 0]).view(np.uint64))
            if last is not None and not pending:  # the gram that is open has several classes, and its last one is out
                give |= own[:, 0] == last[0]
                give[0] = False
            if give.any():
                yield firsts(own[give])
            pending = not give[-1] and (len(own) > 1 or last is None or pending)
            last = own[-1]

    return run


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows of ``words`` (n, k) by multikey quicksort: sort by a word, go on with the next inside equal parts."""
    n, k = words.shape
    order, part = np.arange(n), np.zeros(n, np.int64)
    live = np.arange(n)  # places in ``order`` whose part has other rows
    for j in range(k):
        if not len(live):
            break
        w = words[order[live], j]
        by = np.lexsort((w, part[live]))
        order[live] = order[live[by]]
        w, p = w[by], part[live]
        new = np.concatenate([[True], (w[1:] != w[:-1]) | (p[1:] != p[:-1])])
        start = np.flatnonzero(new)
        part[live] = live[start][np.cumsum(new) - 1]
        alone = np.diff(np.append(start, len(live))) == 1
        live = live[~np.repeat(alone, np.diff(np.append(start, len(live))))]
    return order


def compared(g, d, th, a, off, data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans (d, th, start, end) that earlier suffixes cover in later ones. Rows of a gram stand together."""
    n, left, width = len(g), RUN - 1, RUN - 1 + LENGTH
    size = np.array([len(x) for x in data], np.int64)
    flat = np.frombuffer(b"".join(data), np.uint8)
    row = np.repeat(np.arange(n), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    # bytes aligned at the anchor; what is outside a run differs from everything
    grid = np.zeros((n, width), np.uint8)
    inside = np.zeros((n, width), bool)
    col = place + np.repeat(left - off, size)
    grid[row, col], inside[row, col] = flat[: len(row)], True
    words = np.zeros((n, 13), ">u8")
    words.view(np.uint8)[:, :LENGTH] = grid[:, left:]
    # suffix order inside each group; the common prefix of two suffixes is the least of those of neighbours between them
    order = multikey_order(np.concatenate([g.view(np.uint64)[:, None], words.astype(np.uint64)], 1))
    ended = (grid[order[:-1], left:] != grid[order[1:], left:]) | ~inside[order[:-1], left:] | ~inside[order[1:], left:]
    next_to = np.where(ended.any(1), ended.argmax(1), LENGTH)
    found = []
    lag, live, right = 1, np.arange(n - 1), next_to
    while len(live):
        keep = live + lag < n
        live, right = live[keep], right[keep]
        right = np.minimum(right, next_to[live + lag - 1])
        keep = (g[order[live]] == g[order[live + lag]]) & (right >= GRAM)
        live, right = live[keep], right[keep]
        for at in range(0, len(live), 20_000):
            x, y, r = order[live[at : at + 20_000]], order[live[at : at + 20_000] + lag], right[at : at + 20_000]
            swap = (d[x] > d[y]) | ((d[x] == d[y]) & ((th[x] > th[y]) | ((th[x] == th[y]) & (a[x] > a[y]))))
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            l = ((grid[x, :left] != grid[y, :left]) | ~inside[x, :left] | ~inside[y, :left])[:, ::-1]
            back = np.where(l.any(1), l.argmax(1), left)
            hit = (r + back >= LENGTH) & ~((d[x] == d[y]) & (th[x] == th[y]) & (a[x] == a[y]))
            y = y[hit]
            found.append((d[y], th[y], a[y] - back[hit], a[y] + r[hit]))
        lag += 1
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def halves(lo: int, hi: int, off: int, data: bytes) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(key, lo, hi, off, data) of a suffix in the two halves of its group's window offsets, where it has windows."""
    least, mid = off + LENGTH - len(data), (lo + hi) // 2
    for a, b in ((lo, mid), (mid + 1, hi)):
        first, last = max(least, a), min(off, b)
        if first <= last:
            # the bytes that all windows of the group share
            key = xxhash.xxh64_intdigest(data[off - a : off + LENGTH - b], (a << LOW) + b)
            yield key - (1 << 63), a, b, last, data[off - last : off + LENGTH - first]


def merge_halves(rows: Iterator[tuple]) -> tuple[list[tuple], list[tuple]]:
    """(spans, suffixes) of rows (d, th, a, lo, hi, off, data) halved; of suffixes equal in group and bytes the first stays."""
    first: dict[tuple, tuple] = {}
    spans = []
    for d, th, a, lo, hi, off, data in rows:
        for piece in halves(lo, hi, off, data):
            own, old = (d, th, a), first.setdefault(piece, (d, th, a))
            if old != own:
                if own < old:
                    first[piece], own = own, old
                spans.append((*own[:2], own[2] - piece[3], own[2] - piece[3] + len(piece[4])))
    return spans, [(*own, *piece) for piece, own in first.items()]


def refined(spans: list[tuple], rows: list[tuple]) -> pa.RecordBatch:
    """One batch of spans (d, th, a, end) and suffixes (d, th, a, key, lo, hi, off, data)."""
    n = len(spans)
    whole = [*[(*x, *[None] * 6) for x in spans], *[(d, th, a, None, k, xxhash.xxh64_intdigest(data, off) - (1 << 63), lo, hi, off, data) for d, th, a, k, lo, hi, off, data in rows]]
    kinds = [pa.int64()] * 6 + [pa.int32()] * 3 + [pa.binary()]
    cols = list(zip(*whole, strict=True)) if n + len(rows) else [()] * 10
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], [x.split()[0] for x in REFINED.split(", ")])


def dealt(splitters: Splitters):
    """Suffixes with their bucket first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, x = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(splitters.bucket(k, x)), *batch.columns], ["bucket", *batch.schema.names])

    return run


def refine(splitters: Splitters, group_rows: int):
    """Suffixes (k, x, lo, hi, d, th, a, off, data) sorted by (k, x, d, th, a) to spans and to the suffixes of groups that are large or divided, halved.

    A group of at most ``group_rows`` suffixes is kept from one batch to the next; of a larger one only the last suffix is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        large: int | None = None  # the key of a group that is being halved; the row kept of it is done with
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                now = pa.Table.from_batches([batch])
                now = now if kept is None else pa.concat_tables([kept, now])
            else:
                now = kept
            if now is None or not now.num_rows:
                continue
            now = now.combine_chunks()
            k, x, d, th, a, off = (now[c].to_numpy() for c in ("k", "x", "d", "th", "a", "off"))
            data = now["data"].to_pylist()
            head = np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1])])
            place = np.flatnonzero(head)[np.cumsum(head) - 1]
            spans = []
            for i in np.flatnonzero(~head).tolist():  # equal bytes: all but the first are later
                j = int(place[i])
                if data[i] != data[j] or off[i] != off[j]:
                    head[i] = True  # only the hashes are equal
                elif (d[i], th[i], a[i]) != (d[j], th[j], a[j]):
                    spans.append((d[i], th[i], a[i] - off[i], a[i] - off[i] + len(data[i])))
            own = np.flatnonzero(head)
            key = k[own]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(start, len(own)))
            wide = (size > group_rows) | splitters.divided(np.ascontiguousarray(key[start]).view(np.uint64)) | (key[start] == large if large is not None else False)
            lo, hi = now["lo"].to_numpy(), now["hi"].to_numpy()
            out = np.repeat(wide, size) & (lo[own] < hi[own])
            if large is not None and key[0] == large:
                out[0] = False
            more, rows = merge_halves((int(d[i]), int(th[i]), int(a[i]), int(lo[i]), int(hi[i]), int(off[i]), data[i]) for i in own[out].tolist())
            yield refined(spans + more, rows)
            small = np.repeat(~wide & (size > 1), size)
            if batch is not None:  # the last group may go on
                last = own[start[-1] :]
                small[start[-1] :] = False
                large = int(key[-1]) if wide[-1] else None
                kept = now.take(pa.array(last[-1:] if wide[-1] else last))
            at = own[small]
            for s, e in group_slices(k[at], BUCKET_ROWS):
                i = at[s:e]
                made = compared(k[i], d[i], th[i], a[i], off[i].astype(np.int64), [data[j] for j in i.tolist()])
                if len(made[0]):
                    yield refined(list(zip(*(m.tolist() for m in made), strict=True)), [])

    return run


def group_slices(g: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(g):
        stop = min(len(g), at + rows)
        if stop < len(g):
            stop = int(np.searchsorted(g, g[stop - 1], side="right"))
        yield at, stop
        at = stop


def run_bytes(splitters: Splitters):
    """(d, th, t, reps) to one suffix a rep with its bucket and the bytes of its run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for d, th, t, reps in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for r in reps or ():
                    at, off, n = unpacked(r["a"])
                    for k, v in enumerate((r["g"], r["c"], d, th, at, off, t[at - off : at - off + n - 1 + LENGTH])):
                        out[k].append(v)
            n = len(out[0])
            k, x = (np.array(o, np.int64) for o in out[:2])
            bucket = splitters.bucket(k.view(np.uint64), x.view(np.uint64))
            cols = [pa.array(bucket), pa.array(k), pa.array(x), pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, RUN - 1, np.int32)), *(pa.array(c, pa.int64()) for c in out[2:5]), pa.array(out[5], pa.int32()), pa.array(out[6], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["bucket", "k", "x", "lo", "hi", "d", "th", "a", "off", "data"])

    return run


def sampled_splitters(docs: DataFrame, buckets: int) -> Splitters:
    """From the anchors of some texts."""
    total = docs.count()
    none = np.zeros(0, np.uint64)
    if not total:
        return Splitters(none, none, 1)
    some = docs.sample(min(1.0, 1.5 * SAMPLE_ROWS / total), 7).select(F.substring("t", 1, 20_000)).limit(SAMPLE_ROWS).collect()
    data = b"".join(bytes(r[0]) for r in some)
    ends = np.concatenate([[0], np.cumsum([len(r[0]) for r in some], dtype=np.int64)]).astype(np.int64)
    p = Places(np.frombuffer(data, np.uint8), ends)
    return Splitters(p.gram, p.classes(), buckets) if len(p.at) else Splitters(none, none, 1)


def suffix_splitters(rows: DataFrame, total: int, most: int) -> Splitters:
    """From a sample of suffixes (k, x), for buckets of about BUCKET_ROWS rows, ``most`` at most."""
    buckets = max(1, min(most, total // BUCKET_ROWS))
    some = hash_sample(rows.select("k", "x"), "x", 40 * buckets, total).toArrow() if buckets > 1 else None
    if not some or not some.num_rows:
        return Splitters(np.zeros(0, np.uint64), np.zeros(0, np.uint64), 1)
    return Splitters(*(some[c].to_numpy().view(np.uint64) for c in ("k", "x")), buckets)


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that are done with."""
    gc.collect()
    spark._jvm.System.gc()


def spans_of(docs: DataFrame, group_rows: int) -> DataFrame:
    """Covered spans (d, th, start, end) of ``docs`` (d, th, t), written."""
    spark = docs.sparkSession
    small_batches(spark)
    n = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    splitters = sampled_splitters(docs, 4 * n)
    anchors = docs.mapInArrow(frugal(anchor_rows(splitters)), "bucket int, g long, c long, d long, th long, a long")
    by_class = anchors.repartition("bucket").sortWithinPartitions("g", "c", "d", "th", "a").drop("bucket")
    marks = written(by_class.mapInArrow(frugal(class_firsts(splitters)), "g long, c long, d long, th long, a long"))
    tidy(spark)
    used, spans = [marks], [marks.where("g is null").select("d", "th", F.col("a").alias("start"), F.col("c").alias("end"))]
    firsts = marks.where("g is not null")
    lists = firsts.groupBy("d", "th").agg(F.collect_list(F.struct("g", "c", "a")).alias("reps"))
    texts = docs.join(lists.hint("shuffle_hash"), ["d", "th"]).select("d", "th", "t", "reps")
    keys, total, suffixes = firsts.select(F.col("g").alias("k"), F.col("c").alias("x")), firsts.count(), None
    while total:
        cuts = suffix_splitters(keys, total, 4 * n)
        # one Python worker a task: the first round's suffixes are cut from the texts and dealt at once
        by_key = (texts.mapInArrow(frugal(run_bytes(cuts)), DEALT) if suffixes is None else suffixes.mapInArrow(frugal(dealt(cuts)), DEALT)).repartition("bucket")
        made = written(by_key.sortWithinPartitions("k", "x", "d", "th", "a").drop("bucket").mapInArrow(frugal(refine(cuts, group_rows)), REFINED))
        tidy(spark)
        used.append(made)
        spans.append(made.where("k is null").select("d", "th", F.col("a").alias("start"), "end"))
        keys = suffixes = made.where("k is not null").select("k", "x", "lo", "hi", "d", "th", "a", "off", "data")
        total = suffixes.count()
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    out = written(out)
    for x in used:
        forget(x)
    return out


def keyed(df: DataFrame, doc_id: str, text: str, extra: list[Column]) -> DataFrame:
    """d (the id; null ids last), th (tells rows with one id apart by their text; 0 where all ids are unique), t (UTF-8) and ``extra``."""
    c, i = F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")), F.coalesce(F.col(quoted(doc_id)).cast("long"), F.lit((1 << 63) - 1))
    repeated = df.select(i.alias("d")).groupBy("d").count().where("count > 1").limit(1).count()
    return df.select(i.alias("d"), (F.xxhash64(c) if repeated else F.lit(0).cast("long")).alias("th"), c.cast("binary").alias("t"), *extra)


def with_spans(df: DataFrame, doc_id: str, text: str, extra: list[Column], group_rows: int = GROUP_ROWS) -> DataFrame:
    """d, th, t, ``extra`` and spans (array of start, end: bytes to remove, not merged; null: none) of every row."""
    docs = keyed(df, doc_id, text, extra)
    spans = spans_of(docs.select("d", "th", "t"), group_rows)
    lists = spans.groupBy("d", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return docs.join(lists.hint("shuffle_hash"), ["d", "th"], "left")


def kept_bytes(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """(remaining bytes, removed bytes, maximal removed runs)."""
    if not spans:
        return text, 0, 0
    s, e = merged(np.array([x["start"] for x in spans], np.int64), np.array([x["end"] for x in spans], np.int64))
    cuts = [0, *itertools.chain.from_iterable(zip(s.tolist(), e.tolist(), strict=True)), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)), int((e - s).sum()), len(s)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Every byte goes that a 100-byte string covers which also starts earlier: at a smaller id, or earlier in the same text. Null
    text is empty. Null ids come after all others. Rows with one id are told apart by a hash of their text, which also orders
    them; rows equal in id and text are the same document, so neither is later and both get the same result. Texts shorter
    than 100 bytes stay as they are; an empty table gives no rows; other columns are not read.
    """
    kind = df.schema[doc_id].dataType.simpleString()
    rows = with_spans(df, doc_id, text, [F.col(quoted(doc_id)).alias("doc_id")], group_rows).select("doc_id", "t", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = [kept_bytes(t, s) for t, s in zip(texts, batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64()), pa.array([hashlib.sha256(m[0]).hexdigest() for m in made], pa.string()),
            ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(frugal(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: str | None = "n_chars", group_rows: int = GROUP_ROWS) -> DataFrame:
    """The rows of ``df`` with the repeated bytes out of their text; a character of which a byte goes, goes. ``chars`` (if there) is set to the new length in characters."""
    names = df.columns
    rows = with_spans(df, doc_id, text, [F.struct(*[F.col(quoted(c)) for c in names]).alias("row")], group_rows).select("row", "t", "spans")
    schema = rows.select("row", F.lit("").alias("left")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [kept_bytes(t, s)[0].decode("utf-8", "ignore") for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["row", "left"])

    out = rows.mapInArrow(frugal(run), schema)

    def column(c: str) -> Column:
        own = F.col("row")[c]
        if c == text:
            return F.when(own.isNotNull(), F.col("left")).alias(c)
        if c == chars:
            return F.when(F.col("row")[text].isNotNull(), F.length("left")).otherwise(own).cast(df.schema[c].dataType).alias(c)
        return own.alias(c)

    return out.select(*[column(c) for c in names])
