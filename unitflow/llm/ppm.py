"""Language-model scoring by prediction by partial matching (PPM) over bytes.

Model. A text is its UTF-8 with A-Z lower-cased, then one end symbol. The trie's nodes are byte contexts of up to ``order``
bytes; a node holds its symbols' counts over all training rows. A symbol with count c of n in a node with q different symbols
has probability (2c - 1) / 2n there; the escape q / 2n goes to the next shorter context, from whose symbols those
already seen are excluded. Below the empty context all 256 symbols are alike. Exclusion depends on the node alone, so each
node's escape is kept as one factor: escape / (1 - what its symbols have in the shorter context).

The counts of the longest contexts are gathered over all rows, in sorted blobs by key range; those of shorter ones are
their sums, and probabilities and escape factors are made of them by aggregation. ``order`` is the same at every size, and the
model is a table in the shared folder that grows with the corpus. Only its most frequent entries of the longest order are
broadcast (``most_entries`` at most; which ones decides speed, never a score). What a text needs beyond them is asked for once a
different key, meets the table in a join, at shorter orders where the longest does not have it, and goes back to its text.

Base score. Add-one unigrams of words. The counts of the most frequent words (FREQUENT at most, of LONGEST_WORD bytes at most)
are broadcast; the other words of each document meet their counts in a join, so no vocabulary is cut.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, frugal, held_out, quoted, small_batches, written
from .suffix_dedup import texts_in

ORDER, MOST_ENTRIES, FREQUENT, LONGEST_WORD, RANGES, PIECE = 5, 2_000_000, 200_000, 48, 48, 1_000_000
END = 0xFF  # no byte of UTF-8; also stands before the text
END_WORD = b" "  # no word has white space


def pieces_of(texts: list[bytes], order: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(text's index, the ``order`` bytes before, symbols): long texts in several pieces, the last with the end symbol."""
    pad = bytes([END]) * order
    for i, t in enumerate(texts):
        if len(t) <= PIECE:
            yield i, pad, t + b"\xff"
            continue
        padded = pad + t + b"\xff"
        for at in range(0, len(t) + 1, PIECE):
            yield i, padded[at : at + order], padded[at + order : at + order + PIECE]


def batched(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index of the text, start in keys) of some pieces, and their keys: each symbol (the lowest byte) with its context."""
    own: list[tuple[int, bytes, bytes]] = []
    size = 0
    for piece in itertools.chain(pieces_of(texts, order), [None]):
        if own and (piece is None or size + len(piece[2]) > PIECE):
            data = np.frombuffer(b"".join([x for _, before, body in own for x in (before, body)]), np.uint8)
            key = np.zeros(len(data) - order, np.uint64)
            for j in range(order + 1):
                key = key << np.uint64(8) | data[j : len(data) - order + j]
            sizes = np.array([len(body) for _, _, body in own], np.int64)
            ends = np.cumsum(sizes + order)
            keep = np.ones(len(data), bool)
            for j in range(order):  # the bytes before a piece are no symbols of it
                keep[ends - sizes - order + j] = False
            yield np.array([i for i, _, _ in own]), np.cumsum(sizes) - sizes, key[keep[order:]]
            own, size = [], 0
        if piece:
            own.append(piece)
            size += len(piece[2])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], np.add.reduceat(counts[order], start)


class Hashed:
    """Keys to 32-bit numbers by open addressing in two arrays."""

    FREE = np.uint64((1 << 64) - 1)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 1.7).bit_length())
        self.keys = np.full(1 << self.bits, self.FREE, np.uint64)
        self.values = np.zeros(1 << self.bits, np.float32)
        at, left = self.home(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == self.FREE
            place = left[free]
            self.keys[at[place]] = keys[place]  # one of those that want a slot stays
            stays = self.keys[at[left]] == keys[left]
            self.values[at[left[stays]]] = values[left[stays]]
            left = left[~stays]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, found)"""
        at = self.home(keys)
        got = self.keys[at]
        found = got == keys
        value = self.values[at]
        left = np.flatnonzero(~found & (got != self.FREE))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            got = self.keys[at[left]]
            hit = got == keys[left]
            found[left[hit]] = True
            value[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (got != self.FREE)]
        return value, found


class Entries:
    """The most frequent symbols in contexts of the longest order, with the logarithms of their probabilities."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray, order: int):
        self.keys, self.logs, self.order = keys, logs, order

    def ready(self) -> Entries:
        """The look-up table, made in each worker once."""
        if not hasattr(self, "table"):
            self.table = Hashed(self.keys, self.logs)
            self.keys = self.logs = None
        return self

    def __getstate__(self):
        return {"keys": self.keys, "logs": self.logs, "order": self.order}

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
        """Of each text the sum over the entries, and the keys that are not among them, with their numbers."""
        out, lost = np.zeros(len(texts)), [np.zeros((2, 0), np.uint64)]
        for index, start, keys in batched(texts, self.order):
            value, found = self.table.find(keys)
            np.add.at(out, index, np.add.reduceat(np.where(found, value, np.float32(0)).astype(float), start))
            rest = np.flatnonzero(~found)
            lost.append(np.stack([index[np.searchsorted(start, rest, side="right") - 1].astype(np.uint64), keys[rest]]))
        row, key = np.concatenate(lost, 1)
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])) if len(row) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(row)))
        ends = np.searchsorted(row[first], np.arange(len(texts) + 1, dtype=np.uint64))
        pairs = pa.StructArray.from_arrays([pa.array(key[first].view(np.int64)), pa.array(n.astype(np.int32))], ["k", "n"])
        return out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def blob_rows(order: int):
    """(t) to rows (r, keys, counts): sorted keys and their counts over the task, by range of a hash of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, late = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        for batch in batches:
            for a, b in texts_in(batch, 0):
                for _, _, k in batched([t.lower() for t in batch.column(0).slice(a, b - a).to_pylist()], order):
                    late.append(np.unique(k, return_counts=True))
                    if sum(len(x[0]) for x in late) > max(1_000_000, len(keys)):
                        keys, counts = summed(np.concatenate([keys, *(x[0] for x in late)]), np.concatenate([counts, *(x[1] for x in late)]))
                        late = []
        keys, counts = summed(np.concatenate([keys, *(x[0] for x in late)]), np.concatenate([counts, *(x[1] for x in late)]))
        yield from blobs(keys, counts)

    return run


def blobs(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    r = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(RANGES)
    for i in range(RANGES):
        own = r == i
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([keys[own].tobytes()], pa.binary()), pa.array([counts[own].tobytes()], pa.binary())], ["r", "keys", "counts"])


def merge_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (r, keys, counts) sorted by r to one row a range."""
    at, keys, counts = None, None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([keys.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary()), pa.array([len(keys)], pa.int64())], ["r", "keys", "counts", "n"])

    for batch in batches:
        for r, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            k, c = np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)
            if r != at:
                if at is not None:
                    yield row()
                at, keys, counts = r, k, c
            else:
                keys, counts = summed(np.concatenate([keys, k]), np.concatenate([counts, c]))
    if at is not None:
        yield row()


def blob_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged blobs to one row an entry."""
    for batch in batches:
        for k, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(k, np.int64)), pa.array(np.frombuffer(c, np.int64))], ["k", "c"])


#: A key's order stands above its bytes, and above that whether it is a context (an escape factor) or a symbol in one.
ORDER_BITS, CONTEXT = 56, 1 << 60


def in_order(k: Column, order: int) -> Column:
    """The last bytes of a key that make it one of ``order``."""
    return k.bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))


def fit_model(texts: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """The model of all rows of ``texts`` (t: UTF-8): k and v, the logarithm of a probability or an escape factor; and k, c, v of the longest order."""
    if not 0 <= order <= 6:
        raise ValueError("an order from 0 to 6 is asked for")
    rows = texts.select("t").mapInArrow(frugal(blob_rows(order)), "r int, keys binary, counts binary")
    # one row a range and task
    merged = rows.repartition("r").sortWithinPartitions("r").mapInArrow(frugal(merge_blobs), "r int, keys binary, counts binary, n long")
    levels = {order: written(merged.mapInArrow(frugal(blob_entries), "k long, c long"))}
    for j in range(order - 1, -1, -1):
        levels[j] = written(levels[j + 1].groupBy(in_order(F.col("k"), j).alias("k")).agg(F.sum("c").alias("c")))
    shorter, tables = None, []
    for j in range(order + 1):
        # a context has 256 symbols at most
        context = Window.partitionBy("context")
        own = levels[j].withColumn("context", F.shiftright("k", 8)).withColumns({"n": F.sum("c").over(context), "q": F.count(F.lit(1)).over(context)})
        own = own.withColumn("p", (2 * F.col("c") - 1) / (2 * F.col("n")))
        own = written(own.withColumn("below", F.lit(1 / 256)) if shorter is None else own.join(shorter, in_order(F.col("k"), j - 1) == F.col("short")))
        # every symbol seen (order 0 only): there is nothing to escape to
        left = F.greatest(1 - F.sum("below"), F.lit(1e-12))
        escape = own.groupBy("context").agg(F.log10(F.first("q") / (2 * F.first("n")) / left).cast("float").alias("v"))
        tables.append(own.select(F.col("k") + F.lit(j << ORDER_BITS), "c", F.log10("p").cast("float").alias("v")))
        tables.append(escape.select(F.col("context") + F.lit((j << ORDER_BITS) + CONTEXT), F.lit(0).cast("long"), "v"))
        shorter = own.select(F.col("k").alias("short"), F.col("p").alias("below"))
        levels[j] = (levels[j], own)
    made = tables[0].toDF("k", "c", "v")
    for t in tables[1:]:
        made = made.unionByName(t.toDF("k", "c", "v"))
    made = written(made)
    for pair in levels.values():
        for x in pair:
            forget(x)
    longest = made.where(F.col("k").between(F.lit(order << ORDER_BITS), F.lit(((order + 1) << ORDER_BITS) - 1)))
    return made.select("k", "v"), longest.select(F.col("k") - F.lit(order << ORDER_BITS), "c", "v").toDF("k", "c", "v")


def frequent_entries(longest: DataFrame, order: int, most: int = MOST_ENTRIES) -> Entries:
    """The entries whose count is so high that at most ``most`` have it: 12 bytes each."""
    got = longest.where(F.col("c") >= frequent_from(longest.select(F.col("c").alias("n")), most)).select("k", "v").toArrow()
    k = got["k"].to_numpy().view(np.uint64)
    by = np.argsort(k)
    return Entries(k[by], got["v"].to_numpy()[by], order)


def looked_up(keys: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """k and v, the logarithm of the probability, of different keys ``k`` of the longest order, found at the longest order that has them."""
    k = F.col("k")
    asked = [F.struct(F.lit(j).alias("j"), (in_order(k, j) + F.lit(j << ORDER_BITS)).alias("at")) for j in range(order + 1)]
    # the context of order j is the key of order j - 1 one byte further back
    asked += [F.struct(F.lit(j).alias("j"), ((in_order(F.shiftright(k, 8), j - 1) if j else F.lit(0)) + F.lit((j << ORDER_BITS) + CONTEXT)).alias("at")) for j in range(order + 1)]
    rows = keys.select("k", F.explode(F.array(*asked)).alias("x")).select("k", "x.j", "x.at")
    got = rows.join(model.select(F.col("k").alias("at"), "v"), "at")
    symbol = F.col("at") < F.lit(CONTEXT)
    one = got.groupBy("k").agg(F.max(F.when(symbol, F.struct("j", "v"))).alias("best"), F.collect_list(F.when(~symbol, F.struct("j", "v"))).alias("escapes"))
    best = F.coalesce(F.col("best.j"), F.lit(-1))
    value = F.coalesce(F.col("best.v").cast("double"), F.lit(-math.log10(256)))
    total = F.aggregate(F.array_sort(F.filter("escapes", lambda x: x.j > best)), value, lambda a, x: a + x.v.cast("double"))
    # without any training row the model has no entries
    return keys.join(one.select(k.alias("own"), total.alias("v")), k == F.col("own"), "left").select("k", F.coalesce("v", F.lit(-math.log10(256))).alias("v"))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t) to (w, n): counts of words and text ends, summed over a few batches."""
    seen: Counter[bytes] = Counter()
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            for a, b in texts_in(batch, 0):
                texts = batch.column(0).slice(a, b - a).to_pylist()
                seen[END_WORD] += len(texts)
                seen.update(b"\n".join(texts).lower().split())
        if seen and (batch is None or len(seen) > 400_000):
            yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["w", "n"])
            seen = Counter()


def frequent_from(words: DataFrame, most: int) -> int:
    """A count that at most ``most`` words have or exceed, from a histogram of counts by their logarithm."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    found = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()
    total, least = 0, 1 << 62
    for r in sorted(found, key=lambda r: -r.step):
        total += r.words
        if total > most:
            break
        least = r.least
    return least


def score_rows(entries, frequent):
    """(doc_id, held_out, t) to one row a text: what the broadcast tables tell, and the words and keys they do not have."""
    fields = pa.list_(pa.struct([("w", pa.binary()), ("k", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, get = entries.value.ready(), frequent.value.get
        row = TaskContext.get().partitionId() << 40
        end = get(END_WORD, 0.0)
        for batch in batches:
            for a, b in texts_in(batch, 2):
                part = batch.slice(a, b - a)
                texts = [t.lower() for t in part.column(2).to_pylist()]
                tokens, known, total, rest = [], [], [], []
                for t in texts:
                    words = t.split()
                    logs = list(map(get, words))
                    lost = Counter([w for w, x in zip(words, logs, strict=True) if x is None])
                    found = [x for x in logs if x is not None]
                    tokens.append(len(words) + 1)
                    known.append(len(found) + (end > 0))
                    total.append(math.fsum(found) + end)
                    rest.append([{"w": w, "k": k} for w, k in lost.items()])
                score, keys = model.scores(texts)
                cols = [pa.array(np.arange(row, row + len(texts))), part.column(0), part.column(1), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(total, pa.float64()), pa.array(score), pa.array(rest, fields), keys]
                row += len(texts)
                yield pa.RecordBatch.from_arrays(cols, ["row", "doc_id", "held_out", "n_tokens", "known", "total", "score", "rest", "keys"])

    return run


def score_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, order: int = ORDER, most_entries: int = MOST_ENTRIES, frequent_words: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (PPM, log10) of every row.

    The models learn from all rows that are not held out. Null text is empty: one token, its end. A null id is not held out.
    Repeated rows each give a row and each count. Without training rows the base probability of any token is 1 and the PPM
    probability of each symbol 1/256. An empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    kind = df.schema[doc_id].dataType.simpleString()
    t = F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).cast("binary").alias("t")
    docs = df.select(F.col(quoted(doc_id)).alias("doc_id"), held_out(doc_id, folds).alias("held_out"), t)
    training = docs.where("not held_out").select("t")
    model, longest = fit_model(training, order)
    entries = spark.sparkContext.broadcast(frequent_entries(longest, order, most_entries))
    words = written(training.mapInArrow(frugal(count_words), "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")))
    all_n, all_v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # frequent_words rows of LONGEST_WORD bytes at most
    top = words.where((F.col("n") >= frequent_from(words, frequent_words)) & (F.octet_length("w") <= LONGEST_WORD)).collect()
    top += words.where(F.col("w") == F.lit(END_WORD)).collect()  # the end of a text is looked up here only
    frequent = spark.sparkContext.broadcast({bytes(r.w): math.log10(r.n + 1) for r in top})
    made = docs.mapInArrow(frugal(score_rows(entries, frequent)), f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, total double, score double, rest array<struct<w:binary,k:int>>, keys array<struct<k:long,n:int>>")
    scored = written(made)
    rest = scored.select("row", F.explode("rest").alias("x")).select("row", "x.w", "x.k")
    more = rest.join(words, "w").groupBy("row").agg(F.sum("k").alias("more_known"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more"))
    lost = scored.select("row", F.explode("keys").alias("x")).select("row", "x.k", "x.n")
    found = written(looked_up(lost.select("k").distinct(), model, order))
    symbols = lost.join(found, "k").groupBy(F.col("row").alias("symbol_row")).agg(F.sum(F.col("n") * F.col("v")).alias("symbols"))
    share = math.log10(all_n + all_v + 1)
    base: Column = F.col("total") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(share)
    out = scored.drop("rest", "keys").join(more, "row", "left").join(symbols, F.col("row") == F.col("symbol_row"), "left")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(all_n).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("symbols", F.lit(0.0))).alias("score")
    )
