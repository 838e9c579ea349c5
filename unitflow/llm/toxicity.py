"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers are composed into one table. The lexicon transducer maps words to classes: insult and threat (with a
weight), target, negation, reported speech, other. The negation transducer passes classes on and marks what follows a negation
within its scope; the reported-speech transducer remembers that a clause reports; the target, threat and insult transducers
remember what a clause has named, in any order. Their product reads a clause's classes from left to right, adds the
weights along the path, and its last state tells the pattern: threat (a threat and a target), targeted, plain, negated, reported.
A document's score is a logistic function of its clause weights by pattern.

Insult entries are learned: words and word beginnings that are much more frequent in rows labelled toxic. So are their
weights, those of the threat words, and the logistic function, with a prior that keeps it sensible where labels are few. All are
fitted on a bounded sample of labelled rows (``fit_rows``, half of it toxic rows where there are so many).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, forget, frugal, hash_sample, held_out, map_text, quoted, small_batches, written

#: Seeds of the word classes.
INSULTS = ("idiot", "moron", "scum", "trash", "loser", "worthless", "pathetic", "disgusting", "stupid", "clown")
THREATS = ("kill", "hurt", "destroy", "stab", "shoot", "strangle")
TARGETS = ("you", "your", "he", "she", "they", "him", "her", "them", "du", "dich", "ihr", "er", "sie", "tu", "te", "toi", "vous", "il", "elle", "usted", "ella", "ellos")
NEGATIONS = ("not", "no", "never", "isn", "aren", "don", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "ni")
REPORTS = ("said", "says", "wrote", "claimed", "quoted", "called", "sagte", "dit", "dijo")
PATTERNS = ("plain", "targeted", "negated", "reported", "threat")
#: Prior means of the logistic function: constant, then by pattern.
PRIOR = np.array([-4.0, 1.6, 2.0, 0.8, 0.6, 2.5])
FIT_ROWS, MAX_ENTRIES, MIN_WEIGHT, THREAT_WEIGHT, MIN_SIGNAL, SURE_WEIGHT, SURE_SIGNAL, NEGATION_SCOPE = 8000, 500, 2.5, 3.0, 14.0, 5.0, 150.0, 3
BEGINNINGS = (4, 5, 6, 7, 8, 9)
WORD = re.compile(r"[^\W_]+")
CLAUSE_END = re.compile(r"[.!?;\n]")
#: Word classes, and those that the negation transducer adds.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, NEGATED_INSULT, NEGATED_THREAT = range(8)


class Transducer:
    """A finite-state transducer from state 0: ``step(state, symbol)`` gives (next state, output symbol, factor of the word's weight)."""

    def __init__(self, step: Callable[[tuple, int], tuple[tuple, int, float]], start: tuple = (0,)):
        self.step, self.start = step, start

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one puts out; factors multiply."""
        n = len(self.start)

        def step(state: tuple, symbol: int) -> tuple[tuple, int, float]:
            a, symbol, x = self.step(state[:n], symbol)
            b, symbol, y = other.step(state[n:], symbol)
            return a + b, symbol, x * y

        return Transducer(step, self.start + other.start)

    def table(self, symbols: int) -> tuple[list[tuple], list[list[int]], list[list[float]]]:
        """(states, next state by symbol, factor by symbol), of all states that can be reached."""
        states, moves, factors = [self.start], [], []
        place = {self.start: 0}
        for s in states:  # grows while it is read
            made = [self.step(s, x) for x in range(symbols)]
            for to, _, _ in made:
                if to not in place:
                    place[to] = len(states)
                    states.append(to)
            moves.append([place[to] for to, _, _ in made])
            factors.append([x for _, _, x in made])
        return states, moves, factors


def negation(scope: int = NEGATION_SCOPE) -> Transducer:
    """Marks insults and threats among the ``scope`` words after a negation."""
    marked = {INSULT: NEGATED_INSULT, THREAT: NEGATED_THREAT}
    return Transducer(lambda s, x: ((scope,), OTHER, 1.0) if x == NEGATION else ((max(s[0] - 1, 0),), marked.get(x, x) if s[0] else x, 1.0))


def remembering(symbols: dict[int, int], factor: dict[int, float] | None = None) -> Transducer:
    """Its state is the largest number that ``symbols`` gives for what was read; all is passed on."""
    factor = factor or {}
    return Transducer(lambda s, x: ((max(s[0], symbols.get(x, 0)),), x, factor.get(x, 1.0)))


def clause_transducer() -> Transducer:
    """States (scope, reported, target, threat, insult: 1 negated, 2 plain). A negated threat weighs nothing."""
    return negation().then(remembering({REPORT: 1})).then(remembering({TARGET: 1})).then(remembering({THREAT: 1}, {NEGATED_THREAT: 0.0})).then(remembering({NEGATED_INSULT: 1, INSULT: 2}))


def pattern_of(state: tuple) -> str | None:
    _, reported, target, threat, insult = state
    threat = threat and target
    if not (threat or insult):
        return None
    return "reported" if reported else "threat" if threat else "negated" if insult == 1 else "targeted" if target else "plain"


class Grammar:
    """The composed transducers and the logistic function. Holds a few hundred entries."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float], weights: np.ndarray = PRIOR, threats: dict[str, float] | None = None):
        self.words, self.beginnings, self.weights = words, beginnings, weights
        self.threats = dict.fromkeys(THREATS, THREAT_WEIGHT) | (threats or {})
        self.classes = {w: k for k, own in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS)) for w in own}
        self.sizes = sorted({len(b) for b in beginnings})
        states, self.moves, self.factors = clause_transducer().table(REPORT + 1)
        self.patterns = [pattern_of(s) for s in states]
        # any place where an entry could begin; most texts have none
        found = sorted({*words, *beginnings, *THREATS}, key=lambda w: (-len(w), w))
        self.hint = re.compile("|".join(map(re.escape, found)))

    def word(self, w: str) -> tuple[int, float]:
        """The lexicon transducer: (class, weight) of a lower-case word. A threat word is no insult."""
        if (kind := self.classes.get(w)) == THREAT:
            return THREAT, self.threats[w]
        weight = self.words.get(w, 0.0)
        for n in self.sizes:
            if len(w) > n:
                weight = max(weight, self.beginnings.get(w[:n], 0.0))
        return (INSULT, weight) if weight else (kind or OTHER, 0.0)

    def clause(self, words: list[str]) -> tuple[str, float] | None:
        """The composed transducer over a clause: the pattern that its last state tells, and the weight of its path."""
        state, weight = 0, 0.0
        for w in words:
            kind, own = self.word(w)
            weight += own * self.factors[state][kind]
            state = self.moves[state][kind]
        return (self.patterns[state], weight) if self.patterns[state] else None

    def features(self, text: str) -> list[float]:
        """log(1 + sum of clause weights) by pattern."""
        low = text.lower()
        sums = dict.fromkeys(PATTERNS, 0.0)
        end = 0
        for m in self.hint.finditer(low):
            at = m.start()
            if at < end or (at and (low[at - 1].isalnum())):
                continue
            a = max((low.rfind(c, end, at) for c in ".!?;\n"), default=-1) + 1
            stop = CLAUSE_END.search(low, at)
            a, end = max(a, end), stop.end() if stop else len(low)
            if got := self.clause(WORD.findall(low, a, end)):
                sums[got[0]] += got[1]
        return [math.log1p(sums[p]) for p in PATTERNS]

    def score(self, features: list[float]) -> float:
        z = self.weights[0] + float(np.dot(self.weights[1:], features))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def entries_of(text: str) -> set[str]:
    """Words, and word beginnings marked by a trailing "*"."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) > n}


def signal(t, toxic, c, clean):
    """Log-likelihood ratio of an entry that t of ``toxic`` and c of ``clean`` rows have, against equal rates; 0 where clean rows have it more often."""
    t, c = np.asarray(t, float), np.asarray(c, float)
    rate = (t + c) / max(1, toxic + clean)

    def part(k, n, p):
        n = max(n, 1)
        k, p = np.clip(k, 1e-6, n - 1e-6), np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(k / n / p) + (n - k) * np.log((1 - k / n) / (1 - p))

    return np.where(t * clean > c * toxic, 2 * (part(t, toxic, rate) + part(c, clean, rate)), 0.0)


def learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> tuple[dict[str, float], dict[str, float], dict[str, float]]:
    """Words and beginnings that tell toxic rows of ``rows`` (text, toxic): first, one after the other, the entry that says
    most about the toxic rows without an entry so far, then others that alone say very much. The seeds are always in it. Third,
    the weights of threat words that are among the frequent entries of toxic rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[label].update(entries_of(text or ""))
            names = list(seen[1])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][w] for w in names], pa.int64()), pa.array([seen[0][w] for w in names], pa.int64())], ["entry", "t", "c"])

    # a batch without a toxic row that has the entry does not name it: c is too small here, and counted exactly below
    counts = rows.select("text", "toxic").mapInArrow(count, "entry string, t long, c long").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    excess = F.col("t") / max(1, toxic) - F.col("c") / max(1, clean)
    found = counts.where((F.col("t") >= 2) & (F.col("c") * max(1, toxic) * 4 < F.col("t") * max(1, clean))).orderBy(excess.desc(), "entry").limit(MAX_ENTRIES).collect()
    names = [r.entry for r in found]
    place = {w: i for i, w in enumerate(names)}

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[place[w] for w in entries_of(t or "") if w in place] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.list_(pa.int32()))], ["toxic", "has"])

    has = np.zeros((toxic + clean, len(names)), bool)
    label = np.zeros(toxic + clean, bool)
    for i, r in enumerate(rows.select("text", "toxic").mapInArrow(having, "toxic int, has array<int>").collect()):  # fit_rows rows at most
        label[i], has[i, r.has] = r.toxic == 1, True
    t, c = has[label].sum(0), has[~label].sum(0)
    weight = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
    length = np.array([len(w) for w in names])
    chosen: list[int] = []
    seeds = [place[w] for w in INSULTS if w in place]
    open_rows = has[label][~has[label][:, seeds].any(1)] if seeds else has[label]
    while len(names) and len(open_rows):
        own = open_rows.sum(0)
        gain = signal(own, len(open_rows), c, clean) + length * 1e-3
        gain[(own < 2) | (weight < MIN_WEIGHT) | (gain < MIN_SIGNAL)] = 0
        if not gain.max():
            break
        chosen.append(int(gain.argmax()))
        open_rows = open_rows[~open_rows[:, chosen[-1]]]
    strong = signal(t, toxic, c, clean)
    for i in map(int, np.lexsort((-length, -strong))):
        stem = names[i].removesuffix("*")
        known = [*INSULTS, *(names[j].removesuffix("*") for j in chosen)]
        # neither the beginning of a known entry nor an extension of one says more
        if strong[i] >= SURE_SIGNAL and weight[i] >= SURE_WEIGHT and not any(k.startswith(stem) or stem.startswith(k) for k in known):
            chosen.append(i)
    words, beginnings = dict.fromkeys(INSULTS, MIN_WEIGHT), {}
    for i in chosen:
        (beginnings if names[i].endswith("*") else words)[names[i].removesuffix("*")] = float(weight[i])
    return words, beginnings, {w: max(MIN_WEIGHT, float(weight[place[w]])) for w in THREATS if w in place}


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray = PRIOR, strength: float = 2.0) -> np.ndarray:
    """Newton steps for a logistic function with a Gaussian prior."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w)), x.T @ (y - p) - strength * (w - prior))
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([w[:1], np.maximum(w[1:], 0.0)])


def fit_grammar(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 4, fit_rows: int = FIT_ROWS) -> Grammar:
    """Fit on labelled rows outside the held-out fold. About ``fit_rows`` rows, chosen by a hash of the id, go into it (half more at most).

    Null ids and null labels take no part; an id labelled twice counts as toxic if one label says so; documents that share an id
    are one row of the sample. No labelled rows: the seeds and the prior.
    """
    own = labels.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(label)).cast("int").alias("toxic"))
    own = own.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~(bucket_of_id(folds) == 2)).groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [r for k, n in sorted(sizes.items()) for r in hash_sample(own.where(F.col("toxic") == k), "id", fit_rows // 2, n).collect()]
    if not chosen:
        return Grammar(dict.fromkeys(INSULTS, MIN_WEIGHT), {})
    spark = docs.sparkSession
    picked = F.broadcast(spark.createDataFrame(chosen, own.schema))  # fit_rows rows at most
    texts = docs.select(F.col(quoted(doc_id)).alias("id"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"))
    # rows that share an id are one row, that of the least text
    sample = written(texts.join(picked, "id").groupBy("id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic"))
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    words, beginnings, threats = learn_lexicon(sample, n.get(1, 0), n.get(0, 0))
    grammar = Grammar(words, beginnings, threats=threats)

    def fn(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([grammar.features(x.decode("utf-8", "replace")) for x in texts], pa.list_(pa.float64()))], ["toxic", "x"])

    rows = map_text(sample, ["toxic"], "text", fn, "toxic int, x array<double>").toPandas()
    forget(sample)
    if len(rows):
        grammar.weights = fit_logistic(np.array(rows.x.tolist()).reshape(len(rows), len(PATTERNS)), rows.toxic.to_numpy(float))
    return grammar


def bucket_of_id(folds: int):
    return F.coalesce(bucket_of("id", folds), F.lit(0))


def score_texts(df: DataFrame, grammar: Grammar, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3, folds: int = 4) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) and the weight sums by pattern, of every row.

    Null and empty text get the score of a text without matches. A null id stays null and is not held out; repeated rows
    each give a row; an empty table gives none; other columns are not read. Equal texts get equal scores.
    """
    kind = df.schema[doc_id].dataType.simpleString()

    def fn(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        x = [grammar.features(t.decode("utf-8", "replace")) for t in texts]
        s = [grammar.score(f) for f in x]
        cols = [pa.array([round(math.expm1(f[i]), 6) for f in x], pa.float64()) for i in range(len(PATTERNS))]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32()), *cols], ["doc_id", "score", "predicted", *PATTERNS])

    scored = map_text(df, [doc_id], text, fn, f"doc_id {kind}, score double, predicted int, " + ", ".join(f"{p} double" for p in PATTERNS))
    return scored.select("doc_id", held_out("doc_id", folds).alias("held_out"), "score", "predicted", *PATTERNS)


def keep_clean(df: DataFrame, grammar: Grammar, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``df``, all columns, whose text scores below the threshold. Null text is kept."""
    fields = df.schema
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = fields.names.index(text)
        for batch in batches:
            keep = [grammar.score(grammar.features(t or "")) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(frugal(run), fields)
