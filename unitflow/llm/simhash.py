"""SimHash near-duplicates: fingerprints of word shingles, linked by the generalised pigeonhole principle.

If the 64 bits are cut into m parts with thresholds t_i whose sum is k - m + 1, two fingerprints that differ in at most k
bits differ in at most t_i bits of some part i. The parts group correlated bits; m and the thresholds are those of the least
estimated cost, by dynamic programming over the parts (estimates come from a bounded sample and decide speed only). A part
with threshold 0 is probed by its value, one with threshold 1 by its value without one bit, for each of its bits; one with
threshold -1 is not probed. So a probe is always "equal on a mask", its bucket the fingerprints that agree there.

Equal fingerprints are one node. A bucket of more than ``bucket_rows`` nodes is cut again: the bits outside its mask are dealt
into k + 1 parts, one of which must agree. With few bits left a bucket is small, as nodes differ. In a bucket all pairs are
verified, and of the links only pairs (node, least node that it is linked to, directly or not) leave the task; the components of
these pairs are those of all links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, frugal, hash_sample, map_text, written
from .components import components

WORDS, DISTANCE, BUCKET_ROWS, SAMPLE_ROWS, SEED = 3, 3, 512, 20_000, 42
#: spread[v] has bit j of v in byte j.
SPREAD = (((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint64) << (8 * np.arange(8, dtype=np.uint64))).sum(1, dtype=np.uint64)


def shingles(text: bytes, words: int = WORDS) -> list[bytes]:
    own = text.lower().split()  # bytes: lower() and split() know ASCII only
    if len(own) <= words:
        return [b" ".join(own)] if own else []
    return [b" ".join(x) for x in zip(*(itertools.islice(own, i, None) for i in range(words)), strict=False)]


def fingerprints_of(texts: list[bytes], words: int = WORDS) -> np.ndarray:
    """Unsigned 64-bit fingerprints; a bit is 1 if it is set in over half of the shingle hashes; 0 without words."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, t in enumerate(texts):
        own = shingles(t, words)
        if not own:
            continue
        n = len(own)
        h = np.fromiter([digest(s, SEED) for s in own], np.uint64, n).view(np.uint8).reshape(n, 8)
        # per byte column: 255 rows at most add up without a carry between the lanes
        lanes = np.add.reduceat(SPREAD[h], np.arange(0, n, 255), axis=0)
        counts = lanes.view(np.uint8).reshape(len(lanes), 64).sum(0, dtype=np.int64)
        out[i] = np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id and f (the fingerprint's 64 bits as a signed long) of every row. Null text is empty and gives 0."""
    kind = df.schema[doc_id].dataType.simpleString()

    def fn(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints_of(texts, words).view(np.int64))], ["doc_id", "f"])

    return map_text(df, [doc_id], text, fn, f"doc_id {kind}, f long")


def grouped_bits(sample: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m parts of equal size (by one), each grown from a free bit by the bits most correlated with it."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float)
    spread = bits.std(0)
    near = np.abs(np.nan_to_num((bits - bits.mean(0)).T @ (bits - bits.mean(0)) / max(1, len(sample)) / np.maximum(np.outer(spread, spread), 1e-9)))
    free, parts = list(range(64)), []
    for k in range(m):
        size = 64 // m + (k < 64 % m)
        own = [free.pop(0)]
        while len(own) < size:
            best = max(free, key=lambda b: (near[b, own].sum(), -b))
            free.remove(best)
            own.append(best)
        parts.append(sorted(own))
    return parts


def grouped_order(bits: np.ndarray, size: int = 16) -> np.ndarray:
    """The columns of a 0/1 sample in an order in which correlated ones stand together, in groups of ``size``."""
    x = bits.astype(np.float32) - bits.mean(0, dtype=np.float32)
    spread = np.sqrt((x * x).mean(0))
    near = np.abs(x.T @ x / max(1, len(x)) / np.maximum(np.outer(spread, spread), 1e-9))
    free, out = np.ones(bits.shape[1], bool), []
    while free.any():
        first = int(free.argmax())
        own = np.where(free, near[first], -1.0)
        own[first] = 2.0
        group = np.argsort(-own, kind="stable")[: min(size, int(free.sum()))]
        out.append(group)
        free[group] = False
    return np.concatenate(out)


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def probes(part: list[int], threshold: int) -> list[int]:
    """Masks on which two values agree if they differ in at most ``threshold`` bits of the part."""
    if threshold < 0:
        return []
    return [mask_of([b for b in part if b not in out]) for out in itertools.combinations(part, threshold)]


def estimated(sample: np.ndarray, masks: list[int], n: int) -> float:
    """Rows and candidate pairs that probing n nodes by the masks makes, from a sample of them."""
    scale, cost = n / max(1, len(sample)), 0.0
    for mask in masks:
        sizes = np.unique(sample & np.uint64(mask), return_counts=True)[1].astype(float)
        cost += n + 0.05 * scale * scale * (sizes * (sizes - 1) / 2).sum()
    return cost


def plan(sample: np.ndarray, n: int, distance: int = DISTANCE) -> list[int]:
    """Masks to probe: the cheapest of 2 to distance + 2 parts, with thresholds by dynamic programming."""
    best: tuple[float, list[int]] | None = None
    for m in range(2, distance + 3):
        parts, total = grouped_bits(sample, m), distance - m + 1
        # state: the sum of thresholds so far -> (cost, masks)
        state: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for part in parts:
            options = {t: (estimated(sample, p, n) if (p := probes(part, t)) else 0.0, p) for t in (-1, 0, 1)}
            new: dict[int, tuple[float, list[int]]] = {}
            for s, (cost, masks) in state.items():
                for t, (more, p) in options.items():
                    if s + t not in new or cost + more < new[s + t][0]:
                        new[s + t] = (cost + more, masks + p)
            state = new
        if total in state and (best is None or state[total][0] < best[0]):
            best = state[total]
    return best[1]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def finer(mask: int, distance: int) -> list[int]:
    """Masks that add one of distance + 1 parts of the remaining bits."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | mask_of(rest[i :: distance + 1]) for i in range(distance + 1)]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least index that each of n nodes is linked to by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verify(distance: int):
    """Rows (mask, v, f) sorted by bucket to pairs (f, least f of its component in the bucket)."""

    def links(group: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, first, second, lag = len(f), [], [], 1
        left = np.arange(n)
        while True:
            left = left[left + lag < n]
            left = left[group[left] == group[left + lag]]
            if not len(left):
                break
            hit = left[np.bitwise_count(f[left] ^ f[left + lag]) <= distance]
            first.append(hit)
            second.append(hit + lag)
            lag += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, second))
        root = forest(a, b, n)
        at = np.flatnonzero(root != np.arange(n))
        return f[at], f[root[at]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
                rows = new if kept is None else np.concatenate([kept, new])
                if not len(rows):
                    continue
                last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))
                cut = last[-1] + 1 if len(last) else 0  # the last bucket may go on in the next batch
                rows, kept = rows[:cut], rows[cut:]
            else:
                rows, kept = kept, None
            if rows is None or not len(rows):
                continue
            new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])
            a, b = links(np.cumsum(new), rows[:, 2].view(np.uint64) if rows.flags.c_contiguous is False else np.ascontiguousarray(rows[:, 2]).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def link_forest(nodes: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints f whose components are those of all links at ``distance`` or less."""
    spark = nodes.sparkSession
    n = nodes.count()
    sample = np.array([r[0] for r in hash_sample(nodes.select("f"), "f", SAMPLE_ROWS, n).collect()], np.int64).view(np.uint64)
    masks = plan(sample, n, distance) if n else []
    out = None
    rows = nodes.select("f")
    while masks:
        table = F.array(*[F.lit(signed(m)) for m in masks])
        probed = rows.select("f", F.explode(table).alias("mask")) if out is None else rows
        probed = written(probed.select("mask", F.col("f").bitwiseAND(F.col("mask")).alias("v"), "f"))  # read for sizes, small and large buckets
        sizes = written(probed.groupBy("mask", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        cold = probed.join(sizes.where(F.col("n") <= bucket_rows).select("mask", "v"), ["mask", "v"])
        made = written(cold.repartition("mask", "v").sortWithinPartitions("mask", "v", "f").mapInArrow(frugal(verify(distance)), "a long, b long"))
        out = made if out is None else out.unionByName(made)
        hot = [r[0] % (1 << 64) for r in sizes.where(F.col("n") > bucket_rows).select("mask").distinct().collect()]
        if hot:  # as many masks as parts and levels give at most
            to = spark.createDataFrame([(signed(m), [signed(x) for x in finer(m, distance)]) for m in hot], "mask long, finer array<long>")
            again = probed.join(sizes.where(F.col("n") > bucket_rows).select("mask", "v"), ["mask", "v"]).join(F.broadcast(to), "mask")
            rows = written(again.select("f", F.explode("finer").alias("mask")).distinct())
        masks = hot
        forget(sizes)
        forget(probed)
    return out if out is not None else spark.createDataFrame([], "a long, b long")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id linked to it, directly or not) of every row.

    Null text, empty text and text of white space have the fingerprint zero and are linked like any other. A null id takes part
    and is never a component_id unless no other id is in its component. Repeated rows each give a row; an empty table gives
    none; other columns are not read.
    """
    own = written(fingerprints(df, doc_id, text, words))
    nodes = written(own.groupBy("f").agg(F.min("doc_id").alias("least")))
    links = link_forest(nodes.select("f"), distance)
    found = components(links)
    roots = written(nodes.join(found, nodes.f == found.node, "left").select("f", F.coalesce("root", "f").alias("root"), "least"))
    least = written(roots.groupBy("root").agg(F.min("least").alias("component_id")))
    to = written(roots.join(least, "root").select("f", "component_id"))
    for x in (nodes, links, found, roots, least):
        forget(x)
    return own.join(to, "f").select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
