"""Near-duplicate groups at a similarity well below equality, from wide SimHash fingerprints.

At a Jaccard similarity of 0.8 about 15 % of a fingerprint's bits differ, so 64 bits neither separate such pairs from others
nor can a worst-case pigeonhole prune. Here a fingerprint has 1024 bits, and the pigeonhole holds in probability: parts of
correlated bits, about log2(nodes) wide, are probed by their value, and a dynamic programme over the parts picks which to probe
(threshold 0) and which to skip (threshold -1) at the least estimated number of candidates, such that a pair at the
similarity agrees on a probed part with probability ``recall``. The bits of small sets are biased (ties), so sets of up to SHORT
shingles are probed by bands of minimum hashes too, where a pair agrees with a probability that is exact at every size.

Fingerprints only propose: candidates are checked on 64 further bits, pairs of larger sets then on all 1024, where the estimate
(standard error 0.015 near 0.8) may fall short of the similarity by MARGIN. What is left of a group goes on with its shingle sets,
and each link is decided by the exact Jaccard similarity of the sets (of 64-bit hashes of the shingles). Equal sets are one
node from the start.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, frugal, hash_sample, map_text, quoted, written
from .components import components
from .simhash import SEED, SPREAD, grouped_order, shingles

WORDS, SIMILARITY, RECALL, LANES, SAMPLE_ROWS, CHECK_BITS, MARGIN = 5, 0.8, 0.999, 16, 3000, 22, 0.08
#: Sets of up to SHORT shingles have BANDS keys of BAND minimum hashes each and CHECK_BITS_SHORT.
SHORT, BANDS, BAND, CHECK_BITS_SHORT = 64, 30, 6, 30
#: Added to the share of differing bits: exact binomials give 0.0025 more than the angle at 52 shingles, the least size that bits must find.
BIAS = 0.003
#: Odd factors that make further hashes of a hash; the last is for the check bits.
FACTORS = np.random.default_rng(99).integers(0, 1 << 63, LANES + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
XORS, ODDS = np.random.default_rng(98).integers(0, 1 << 63, (2, BANDS * BAND), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def set_of(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles."""
    own = shingles(text, words)
    return np.unique(np.fromiter([xxhash.xxh64_intdigest(s, SEED) for s in own], np.uint64, len(own)))


def bands_of(h: np.ndarray) -> np.ndarray:
    """BANDS negative numbers, each a hash of BAND minimum hashes of the set."""
    x = (h[:, None] ^ XORS) * ODDS
    x ^= x >> np.uint64(32)
    least = (x * FACTORS[0]).min(0).reshape(BANDS, BAND)
    return np.array([-1 - (xxhash.xxh64_intdigest(b.tobytes(), i) >> 1) for i, b in enumerate(least)], np.int64)


def wide_of(text: bytes, words: int = WORDS) -> tuple[bytes, int, int, int, np.ndarray | None]:
    """(1024 bits, 64 check bits as a signed number, number of different shingles, hash of their set, bands of a small set)."""
    h = set_of(text, words)
    n, out = len(h), []
    node = xxhash.xxh64_intdigest(h.tobytes(), SEED) - (1 << 63)
    if not n:
        return bytes(8 * LANES), 0, 0, node, None
    starts = np.arange(0, n, 255)
    for f in FACTORS:
        x = h * f
        x ^= x >> np.uint64(31)
        x *= FACTORS[0]
        x ^= x >> np.uint64(29)
        lanes = np.add.reduceat(SPREAD[x.view(np.uint8).reshape(n, 8)], starts, axis=0)
        counts = lanes.view(np.uint8).reshape(len(lanes), 64).sum(0, dtype=np.int64)
        out.append(np.packbits(counts * 2 > n, bitorder="little"))
    return b"".join(o.tobytes() for o in out[:-1]), int(out[-1].view(np.int64)[0]), n, node, bands_of(h) if n <= SHORT else None


def differing(similarity: float) -> float:
    """Share of bits in which two equally large sets of that Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def parts_of(sample: np.ndarray, n: int, similarity: float, recall: float) -> list[list[int]]:
    """The parts to probe, each a list of bit numbers.

    Parts are stretches of the bits in an order in which correlated ones stand together, then of shuffles of it. Costs: the
    candidate pairs that a sample shows. The dynamic programme keeps, for each (rounded) logarithm of the probability that a
    pair is missed, the cheapest choice.
    """
    width = min(24, max(12, math.ceil(math.log2(max(2, n)))))
    agree = (1 - differing(similarity) - BIAS) ** width
    need = math.ceil(math.log(1 - recall) / math.log(1 - agree))
    order = grouped_order(sample)
    rng = np.random.default_rng(5)
    parts: list[list[int]] = []
    while len(parts) < need * 5 // 4:
        parts += [sorted(order[i : i + width].tolist()) for i in range(0, len(order) - width + 1, width)]
        order = rng.permutation(order)
    costs = []
    for p in parts:
        v = (sample[:, p] * (1 << np.arange(width, dtype=np.int64))).sum(1)
        c = np.unique(v, return_counts=True)[1].astype(float)
        costs.append(n + (n / max(1, len(sample))) ** 2 * (c * (c - 1) / 2).sum())
    best: list[tuple[float, tuple]] = [(0.0, ())]  # by number of probed parts, as all agree with one probability
    for i, cost in enumerate(costs):
        new = [*best, (math.inf, ())]
        for k, (total, chosen) in enumerate(best):
            if k < need and total + cost < new[k + 1][0]:
                new[k + 1] = (total + cost, (chosen, i))
        best = new[: need + 1]
    out, chain = [], best[-1][1]
    while chain:
        chain, i = chain
        out.append(parts[i])
    return out


def probe_rows(parts: list[list[int]]):
    """(node, fp, check) to (part, value, node, check)."""
    width = len(parts[0])
    index = np.array(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                bits = unpacked(part.column(1).to_pylist())
                v = np.zeros((len(bits), len(parts)), np.int64)
                for j in range(width):
                    v |= bits[:, index[:, j]].astype(np.int64) << j
                v |= np.arange(len(parts), dtype=np.int64) << 32
                yield pa.RecordBatch.from_arrays([pa.array(v.reshape(-1)), pa.array(np.repeat(part.column(0).to_numpy(), len(parts))), pa.array(np.repeat(part.column(2).to_numpy(), len(parts)))], ["key", "node", "check"])

    return run


def unpacked(fps: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups of the first column, from batches sorted by it. A group that spans many batches is put together once."""
    kept: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        key = now.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        ended = kept and kept[-1].column(0)[0].as_py() != key[0]
        if cut or ended:
            yield pa.concat_tables([*kept, now.slice(0, cut)]).combine_chunks()
            kept = []
        kept.append(now.slice(cut))
    if kept:
        yield pa.concat_tables(kept).combine_chunks()


def searched(n: int, near) -> list[tuple[int, int]]:
    """A spanning forest of n rows: breadth-first, each row reached is compared with the rows not reached so far only."""
    free, out = np.arange(n), []
    while len(free):
        queue, free = [int(free[0])], free[1:]
        while queue and len(free):
            x = queue.pop()
            hit = near(x, free)
            if hit.any():
                out += [(x, int(y)) for y in free[hit]]
                queue += free[hit].tolist()
                free = free[~hit]
    return out


def close_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, check) sorted by key to the (key, node) that have a partner within CHECK_BITS in their group."""
    for table in grouped(batches):
        key, node, check = (table.column(i).to_numpy() for i in range(3))
        check = check.view(np.uint64)
        most = np.where(key < 0, CHECK_BITS_SHORT, CHECK_BITS)
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        fine = np.zeros(len(key), bool)
        # small groups: all pairs, by distance in the order; others: near their neighbours in the order, or searched
        small = np.repeat(size <= 64, size)
        live, lag = np.flatnonzero(small), 1
        while len(live):
            live = live[live + lag < len(key)]
            live = live[key[live] == key[live + lag]]
            hit = live[np.bitwise_count(check[live] ^ check[live + lag]) <= most[live]]
            fine[hit] = fine[hit + lag] = True
            lag += 1
        for s, n in zip(start[size > 64].tolist(), size[size > 64].tolist(), strict=True):
            own = check[s : s + n]
            for a, b in searched(n, lambda x, rest, own=own, most=most[s]: np.bitwise_count(own[x] ^ own[rest]) <= most):
                fine[s + a] = fine[s + b] = True
        if fine.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[fine]), pa.array(node[fine])], ["key", "node"])


def similar(x: np.ndarray, size: float, rest: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the Jaccard similarity that the bits tell may reach ``similarity``; of small sets whether the sizes allow it."""
    bits = np.bitwise_count(x ^ rest).sum(1)
    both = np.cos(np.pi * bits / (64 * LANES)) * np.sqrt(size * sizes)
    may = both >= (similarity - MARGIN) * (size + sizes - both)
    return (may | (np.minimum(size, sizes) <= SHORT)) & (np.minimum(size, sizes) / np.maximum(size, sizes) >= similarity)


def proposed_rows(similarity: float):
    """(key, node, fp, size) sorted by key to (team, node): the components of similar() in each group, numbered by a hash of their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            key, node = table.column(0).to_numpy(), table.column(1).to_numpy()
            fp = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint64).reshape(len(key), LANES)
            size = table.column(3).to_numpy().astype(float)
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            teams, nodes, seen = [], [], set()
            for s, e in zip(start.tolist(), np.append(start[1:], len(key)).tolist(), strict=True):
                near = lambda x, rest, s=s: similar(fp[s + x], size[s + x], fp[s + rest], size[s + rest], similarity)
                at: dict[int, int] = {}
                own: dict[int, list[int]] = {}
                for x, y in searched(e - s, near):  # breadth-first: x is the first of its component or has been reached
                    at[y] = at.get(x, x)
                    own.setdefault(at[y], [at[y]]).append(y)
                for rows in own.values():
                    team = np.sort(node[s + np.array(rows)])
                    number = xxhash.xxh64_intdigest(team.tobytes(), SEED) - (1 << 63)
                    if number not in seen:
                        seen.add(number)
                        teams.append(np.full(len(team), number))
                        nodes.append(team)
            if teams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(teams)), pa.array(np.concatenate(nodes))], ["team", "node"])

    return run


def reaching(sets: list[np.ndarray], sizes: np.ndarray, similarity: float):
    """Whether the exact Jaccard similarity of set x and each of ``rest`` reaches ``similarity``; no set is empty."""

    def near(x: int, rest: np.ndarray) -> np.ndarray:
        own, out = sets[x], np.zeros(len(rest), bool)
        may = np.flatnonzero(np.minimum(sizes[x], sizes[rest]) / np.maximum(sizes[x], sizes[rest]) >= similarity)
        for at in range(0, len(may), 256):
            some = may[at : at + 256]
            n = sizes[rest[some]]
            flat = np.concatenate([sets[r] for r in rest[some].tolist()])
            hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(n) - n)
            out[some] = both / (len(own) + n - both) >= similarity
        return out

    return near


def linked_rows(similarity: float):
    """(team, node, set) sorted by team to links (a, b): a spanning forest of the pairs that reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            team, node = table.column(0).to_numpy(), table.column(1).to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in table.column(2).chunks for x in c]
            sizes = np.array([len(x) for x in sets])
            start = np.flatnonzero(np.concatenate([[True], team[1:] != team[:-1]]))
            a, b = [], []
            for s, e in zip(start.tolist(), np.append(start[1:], len(team)).tolist(), strict=True):
                for x, y in searched(e - s, reaching(sets[s:e], sizes[s:e], similarity)):
                    a.append(node[s + x])
                    b.append(node[s + y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def decided(docs: DataFrame, similarity: float, words: int, recall: float) -> DataFrame:
    """(id, th) of the rows to keep, from docs (id, th, t): the least of each group."""
    spark = docs.sparkSession

    def fn(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        made = [wide_of(t, words) for t in texts]
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array([m[i] for m in made], t) for i, t in enumerate(types))], ["id", "th", "fp", "check", "size", "node", "bands"])

    def sets(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([set_of(t, words).tobytes() for t in texts], pa.binary())], ["node", "set"])

    kind = docs.schema["id"].dataType.simpleString()
    rows = written(map_text(docs, ["id", "th"], "t", fn, f"id {kind}, th long, fp binary, check long, size long, node long, bands array<long>"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("least")
    # a node's number is a hash of its set of shingles
    nodes = written(rows.groupBy("node").agg(first, *(F.first(c).alias(c) for c in ("fp", "check", "size", "bands"))))
    if nodes.count() < 2:
        return nodes.select("least.id", "least.th")
    long = nodes.where(F.col("size") >= F.lit(SHORT * similarity))
    n = long.count()
    probes = nodes.select(F.explode("bands").alias("key"), "node", "check")
    if n > 1:
        sample = unpacked([bytes(r[0]) for r in hash_sample(long, "node", SAMPLE_ROWS, n).select("fp").collect()])
        parts = parts_of(sample, n, similarity, recall)
        probes = probes.unionByName(long.select("node", "fp", "check").mapInArrow(frugal(probe_rows(parts)), "key long, node long, check long"))
    close = written(probes.repartition("key").sortWithinPartitions("key").mapInArrow(frugal(close_rows), "key long, node long"))
    held = close.join(nodes.select("node", "fp", "size"), "node").select("key", "node", "fp", "size")
    teams = written(held.repartition("key").sortWithinPartitions("key").mapInArrow(frugal(proposed_rows(similarity)), "team long, node long").distinct())
    # the text of each proposed node's first row gives its set again
    asked = nodes.join(teams.select("node").distinct(), "node").select("node", F.col("least.id").alias("least_id"), F.col("least.th").alias("least_th"))
    texts = docs.join(asked.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("least_id")) & (F.col("th") == F.col("least_th"))).select("node", "t")
    made = written(map_text(texts, ["node"], "t", sets, "node long, set binary").dropDuplicates(["node"]))
    pairs = teams.join(made, "node").select("team", "node", "set")
    links = written(pairs.repartition("team").sortWithinPartitions("team").mapInArrow(frugal(linked_rows(similarity)), "a long, b long"))
    roots = nodes.join(components(links), "node", "left").select(F.coalesce("root", "node").alias("root"), "least")
    kept = roots.groupBy("root").agg(F.min("least").alias("least")).select("least.id", "least.th")
    kept = written(kept)
    for x in (rows, nodes, close, teams, made, links):
        forget(x)
    return kept


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """The rows of ``df``, all columns: of each group of near-duplicates the one with the least id (null ids last) stays.

    Groups are the components of pairs with a Jaccard similarity of ``similarity`` or more of their sets of
    ``words``-word shingles; a text with fewer words is one shingle, texts without words (and null texts) are alike. Of rows
    equal in id and text one stays. An empty table gives none; extra columns stay as they are.
    """
    t = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    i, th = F.col(quoted(doc_id)), F.xxhash64(t)
    kept = decided(df.select(i.alias("id"), th.alias("th"), t.alias("t")), similarity, words, recall)
    inner = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"), i.alias("id"), th.alias("th"))
    repeated = inner.groupBy("id", "th").count().where("count > 1").limit(1).count()
    kept = kept.select(F.col("id").alias("kept_id"), F.col("th").alias("kept_th"))
    out = inner.join(kept.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("th") == F.col("kept_th")), "left_semi")
    if repeated:
        out = out.dropDuplicates(["id", "th"])
    return out.select(*[F.col("row")[c].alias(c) for c in df.columns])
