"""Approximate nearest neighbours by balanced posting lists, for the largest inner product.

Inner products become distances: each vector gets one more component, sqrt(M^2 - |x|^2) with M the largest norm (0 for a
query), so that the nearest vector is the one with the largest inner product. Centroids come from a hierarchical clustering
of a sample: clusters above the leaf size are split again, which keeps lists balanced. There are rows / LIST_ROWS lists, or
ROOTS * sqrt(rows) where that is less (from a million rows on), so that centroids and rows of a list grow alike: at a thousand million
rows 126 thousand centroids (some 65 MB at 64 dimensions) and lists of some 8000 rows; work grows as rows^1.5. The sample has
``fit_rows`` rows, and from four million rows on SAMPLE_A_LIST for each list. Every vector is put into the list of its nearest
centroid and, near a boundary, into further ones whose distance is within CLOSURE times the nearest. A query searches the centroids
by a best-first walk on their neighbour graph and probes the lists whose distance is within a ratio of the nearest, and the next
nearest until they hold more than k different rows. The ratio is calibrated: the one that reaches ``target`` of the true neighbours
of some sample rows within the sample. Neighbours in all rows are nearer than those in a sample, so the recall is no lower there.

Neighbouring lists make up shards of SHARD_ROWS vectors; a list that is larger is dealt over several shards by a hash. A query
goes to the shards that hold lists it probes, once each, and leaves each with k rows. Queries of a shard are dealt into
blocks by a hash. Scores are inner products in double precision of the original vectors, summed in one fixed order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import frugal, hash_sample, quoted, small_batches, written

FIT_ROWS, SAMPLE_A_LIST, LIST_ROWS, ROOTS, SHARD_ROWS, QUERY_ROWS = 16_384, 2, 256, 4, 8192, 4096
COPIES, CLOSURE, TARGET, TRIALS, DEGREE, BEAM, STEP = 3, 1.02, 0.97, 256, 24, 64, 32


def usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and e (array of double) of the rows that take part: not null, not all zero, all components finite, and of the most frequent length."""
    e = F.col(quoted(embedding)).cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf))) & F.exists(e, lambda x: x != 0)
    own = df.select(F.col(quoted(vec_id)).alias("vec_id"), e.alias("e")).where(F.col("vec_id").isNotNull() & e.isNotNull() & F.coalesce(fine, F.lit(False)))
    return own


def centres_of(x: np.ndarray, leaf: int, rng: np.random.Generator) -> np.ndarray:
    """Means of the clusters of a hierarchical clustering with at most ``leaf`` rows each, as far as rows differ."""
    out, todo = [], [x]
    while todo:
        own = todo.pop()
        if len(own) <= leaf or (own == own[0]).all():
            out.append(own.mean(0))
            continue
        k = min(16, max(2, -(-len(own) // leaf)))
        c = own[rng.choice(len(own), k, replace=False)]
        for _ in range(8):
            near = ((c**2).sum(1) - 2 * own @ c.T).argmin(1)
            c = np.stack([own[near == j].mean(0) if (near == j).any() else own[rng.integers(len(own))] for j in range(k)])
        near = ((c**2).sum(1) - 2 * own @ c.T).argmin(1)
        parts = [own[near == j] for j in range(k) if (near == j).any()]
        if len(parts) == 1:
            out.append(own.mean(0))
        else:
            todo += parts
    return np.array(out)


def lists_for(rows: int) -> int:
    return max(1, math.ceil(min(rows / LIST_ROWS, ROOTS * math.sqrt(rows))))


class Index:
    """Centroids and their neighbour graph; twice lists_for(rows) centroids at most, as clusters are split unevenly."""

    def __init__(self, sample: np.ndarray, rows: int, seed: int = 11):
        self.m = float(np.sqrt((sample**2).sum(1).max())) if len(sample) else 0.0
        self.c = np.zeros((0, sample.shape[1] + 1))
        self.rows, self.sample, self.seed = rows, sample, seed

    def fit(self, norm: float, k: int = 20, target: float = TARGET) -> Index:
        self.m = norm
        lists = lists_for(self.rows)
        x = self.lifted(self.sample)
        self.c = centres_of(x, max(1, len(x) // lists), np.random.default_rng(self.seed))[: 2 * lists]
        self.ratio = self.calibrated(self.sample, k, target)
        self.sample = None
        k = min(DEGREE, len(self.c) - 1)
        near = np.zeros((len(self.c), k), np.int64)
        step = self.block()
        for at in range(0, len(self.c), step) if k else ():
            d = self.distances(self.c[at : at + step])
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            own = np.argpartition(d, k - 1, axis=1)[:, :k]
            near[at : at + step] = np.take_along_axis(own, np.argsort(np.take_along_axis(d, own, 1), axis=1, kind="stable"), 1)
        links = [set(r) for r in near.tolist()]
        for i, own in enumerate(near.tolist()):
            for j in own[: k // 2]:
                links[j].add(i)
        self.links = [np.array(sorted(x), np.int64) for x in links]
        self.start = int(((self.c - self.c.mean(0)) ** 2).sum(1).argmin())
        return self

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.m**2 - (x**2).sum(1), 0.0))[:, None]])

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x**2).sum(1)[:, None] + (self.c**2).sum(1) - 2 * x @ self.c.T, 0.0)

    def block(self) -> int:
        """Rows whose distances to all centroids are made at once: 16 MB."""
        return max(1, 2_000_000 // max(1, len(self.c)))

    def lists(self, x: np.ndarray) -> list[list[int]]:
        """The lists of each vector."""
        step = self.block()
        return [own for at in range(0, len(x), step) for own in self.near(x[at : at + step])]

    def near(self, x: np.ndarray) -> list[list[int]]:
        d = np.sqrt(self.distances(self.lifted(x)))
        k = min(COPIES, d.shape[1])
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
        own = np.take_along_axis(d, near, 1)
        return [r[m].tolist() for r, m in zip(near, own <= own[:, :1] * CLOSURE, strict=True)]

    def calibrated(self, x: np.ndarray, k: int, target: float) -> float:
        """The distance ratio within which ``target`` of the k nearest of some rows of x are listed."""
        if len(x) < 2 or len(self.c) < 2:
            return 1.0
        own = self.lists(x)
        needed = []
        for i in np.linspace(0, len(x) - 1, min(TRIALS, len(x))).astype(int):
            s = x @ x[i]
            s[i] = -np.inf
            d = np.sqrt(((self.c - np.append(x[i], 0.0)) ** 2).sum(1))
            needed += [d[own[j]].min() / max(d.min(), 1e-300) for j in np.argsort(-s, kind="stable")[: min(k, len(x) - 1)]]
        return float(np.quantile(needed, target)) * (1 + 1e-9)

    def probes(self, q: np.ndarray, sizes: dict[int, int] | None = None, floor: int = 0) -> list[int]:
        """The lists to probe for a query: best-first walk, pruning by the distance ratio, then the next nearest up to ``floor`` rows."""
        lifted, ratio = np.append(q, 0.0), self.ratio
        dist = lambda nodes: np.sqrt(((self.c[nodes] - lifted) ** 2).sum(1))
        far = np.full(len(self.c), np.inf)  # distances of the nodes that were met
        opened = np.zeros(len(self.c), bool)
        met = np.array([self.start])
        far[met] = dist(met)
        while True:
            own = far[met]
            bound = max(own.min() * ratio, np.partition(own, BEAM - 1)[BEAM - 1] if len(met) > BEAM else np.inf)
            near = met[(own <= bound) & ~opened[met]]
            if not len(near):
                break
            near = near[np.argsort(far[near], kind="stable")[:STEP]]  # the nearest few at once
            opened[near] = True
            new = np.unique(np.concatenate([self.links[j] for j in near.tolist()]))
            new = new[np.isinf(far[new])]
            far[new] = dist(new)
            met = np.concatenate([met, new])
        out = set(met[own <= own.min() * ratio].tolist())
        rows = sum(sizes.get(j, 0) for j in out) if sizes is not None else floor
        if rows < floor:
            for j in np.argsort(dist(np.arange(len(self.c))), kind="stable").tolist():
                if j not in out:
                    out.add(j)
                    rows += sizes.get(j, 0)
                    if rows >= floor:
                        break
        return sorted(out)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def listed(index):
    """(vec_id, e) to (vec_id, e, lists)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(index.value.lists(matrix(batch.column(1))), pa.list_(pa.int32()))], ["vec_id", "e", "lists"])

    return run


def sharded(sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """(first shard, shards) of each list: lists in order fill shards; a large list has shards of its own."""
    out, shard, filled = {}, 0, 0
    for j in sorted(sizes):
        n = -(-sizes[j] // SHARD_ROWS)
        if filled and (n > 1 or filled + sizes[j] > SHARD_ROWS):
            shard, filled = shard + 1, 0
        out[j] = (shard, n)
        if n > 1:
            shard += n
        else:
            filled += sizes[j]
    return out


def probing(index, shards, sizes, floor):
    """Queries (vec_id, e) to one row a shard: (shard, vec_id, e, lists probed there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, row, lists = [], [], []
            for i, q in enumerate(matrix(batch.column(1)) if batch.num_rows else ()):
                own: dict[int, list[int]] = {}
                for j in index.value.probes(q, sizes.value, floor):
                    first, n = shards.value.get(j, (0, 0))
                    for k in range(first, first + n):
                        own.setdefault(k, []).append(j)
                for k, js in own.items():
                    shard.append(k)
                    row.append(i)
                    lists.append(js)
            chosen = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *chosen.columns, pa.array(lists, pa.list_(pa.int32()))], ["shard", "vec_id", "e", "lists"])

    return run


def scored(q: np.ndarray, qid: np.ndarray, x: np.ndarray, vid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, product) of each query's k best rows, ties to the smaller id."""
    s = q @ x.T
    s[qid[:, None] == vid] = -np.inf
    # products near the k-th stay until they are summed in the fixed order
    slack = 1e-9 * max(1e-300, float(np.abs(q).max() * np.abs(x).max())) * q.shape[1]
    # the k-th of different ids: rows of one id count once
    order = np.argsort(vid, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], vid[order][1:] != vid[order][:-1]]))
    top = s if len(start) == len(vid) else np.maximum.reduceat(s[:, order], start, axis=1)
    least = np.partition(top, -k, axis=1)[:, -k] if top.shape[1] > k else np.full(len(s), -np.inf)
    i, j = np.nonzero((s >= least[:, None] - slack) & (s > -np.inf))
    return best(i, j, np.einsum("ij,ij->i", q[i], x[j]), vid, k)


def best(i: np.ndarray, j: np.ndarray, s: np.ndarray, vid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    # the largest product of each id: copies in several lists, and rows that share an id
    order = np.lexsort((-s, vid[j], i))
    i, j, s = i[order], j[order], s[order]
    new = np.concatenate([[True], (i[1:] != i[:-1]) | (vid[j][1:] != vid[j][:-1])]) if len(i) else np.zeros(0, bool)
    i, j, s = i[new], j[new], s[new]
    order = np.lexsort((vid[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep], s[keep]


def best_of(k: int):
    """One shard's block of queries to each query's k best there."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and rows.num_rows:
            qid, q = queries["vec_id"].to_numpy(), matrix(queries["e"])
            probed = queries["lists"].combine_chunks()
            row = np.repeat(np.arange(len(qid)), pc.list_value_length(probed).to_numpy())
            which = probed.flatten().to_numpy()
            order = np.argsort(rows["list"].to_numpy(), kind="stable")
            rows = rows.take(pa.array(order))
            lst, vid, x = rows["list"].to_numpy(), rows["vec_id"].to_numpy(), matrix(rows["e"])
            for at in range(0, len(qid), 512):
                some = (row >= at) & (row < at + 512)
                found = []
                for j in np.unique(which[some]):
                    a, b = np.searchsorted(lst, [j, j + 1])
                    if a == b:
                        continue
                    own = row[some][which[some] == j]
                    i, v, s = scored(q[own], qid[own], x[a:b], vid[a:b], k)
                    found.append((own[i], v + a, s))
                if found:
                    i, v, s = best(*(np.concatenate(f) for f in zip(*found, strict=True)), vid, k)
                    out.append((qid[i], vid[v], s))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(cols, ["query_id", "vec_id", "score"])

    return run


def nearest(df: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20, target: float = TARGET, fit_rows: int = FIT_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for every row whose id is divisible by ``every``.

    Null ids and vectors, zero vectors, vectors with null or non-finite components and those not of the most frequent length
    take no part. Ties go to the smaller id. Rows with one id are one candidate (that with the larger product); rows with the
    query's id are its own. Fewer rows only where all candidates are fewer than k: a query whose probed lists have fewer different
    ids (rows of one id) is compared with all rows. An empty table gives none.
    """
    spark = df.sparkSession
    small_batches(spark)
    own = usable(df, vec_id, embedding)
    sizes = own.groupBy(F.size("e").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).orderBy(F.col("rows").desc(), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    own = own.where(F.size("e") == sizes.n)
    sample = hash_sample(own, "vec_id", max(fit_rows, SAMPLE_A_LIST * lists_for(sizes.rows)), sizes.rows).select("e").toArrow()
    index = spark.sparkContext.broadcast(Index(matrix(sample["e"]), sizes.rows).fit(math.sqrt(sizes.m), k, target))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    rows = written(own.mapInArrow(frugal(listed(index)), "vec_id long, e array<double>, lists array<int>").select("vec_id", "e", F.explode("lists").alias("list")))
    counts = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a list
    held = {r.list: r.n for r in counts}
    place = sharded(held)
    shards = spark.sparkContext.broadcast(place)
    queries = written(own.where(is_query).mapInArrow(frugal(probing(index, shards, spark.sparkContext.broadcast(held), COPIES * (k + 1))), "shard int, vec_id long, e array<double>, lists array<int>"))

    where = F.broadcast(spark.createDataFrame([(j, a, n) for j, (a, n) in place.items()], "list int, first int, shards int"))
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    dealt = rows.join(where, "list").withColumn("shard", F.col("first") + spread("shards"))
    one = written(products(queries, dealt, k))

    # a row stands in COPIES lists at most, so only rows that share an id can leave a query short
    most = min(k, own.select("vec_id").distinct().count() - 1)
    got = one.groupBy("query_id").agg(F.count(F.lit(1)).alias("got"))
    asking = own.where(is_query)
    short = written(asking.join(got, F.col("vec_id") == F.col("query_id"), "left").where(F.coalesce("got", F.lit(0)) < most).select("vec_id", "e"))
    if short.limit(1).count():
        n = -(-sizes.rows // SHARD_ROWS)
        again = short.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"), "vec_id", "e", F.array(F.lit(0)).alias("lists"))
        whole = own.select(F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("shard"), F.lit(0).alias("list"), "vec_id", "e")
        one = one.unionByName(products(again, whole, k)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return one.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def products(queries: DataFrame, dealt: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id and score of each query's k best in each shard, from queries (shard, vec_id, e, lists) and rows (shard, list, vec_id, e)."""
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    blocks = queries.groupBy("shard").agg(F.greatest(F.ceil(F.count(F.lit(1)) / QUERY_ROWS), F.lit(1)).cast("int").alias("blocks"))
    dealt = dealt.join(blocks, "shard")
    dealt = dealt.select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "list", "vec_id", "e")
    asked = queries.join(blocks, "shard").select("shard", spread("blocks").alias("block"), "vec_id", "e", "lists")
    pairs = asked.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block"))
    found = pairs.applyInArrow(best_of(k), "query_id long, vec_id long, score double")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
