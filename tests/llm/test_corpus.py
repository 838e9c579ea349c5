"""Operators on whole corpora against brute force."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from unitflow.llm import components, curriculum, ppm, simhash, simhash_groups, spann, suffix_dedup, toxicity


def rooted(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


# --- toxicity ----------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    g = toxicity.fit_grammar(docs, labels)
    labelled = docs.join(F.broadcast(labels.select("doc_id", "toxic")), "doc_id")
    rows = toxicity.score_texts(labelled, g).join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = rows[rows.toxic == 1], rows[rows.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.8
    assert (clean.predicted == 0).mean() > 0.97


def test_toxicity_edges(spark, odd_docs, no_docs, odd_rows):
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    g = toxicity.fit_grammar(odd_docs, labels)
    rows = toxicity.score_texts(odd_docs, g).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert toxicity.score_texts(no_docs, g).count() == 0
    assert toxicity.keep_clean(odd_docs, g).columns == odd_docs.columns
    assert toxicity.fit_grammar(no_docs, labels.limit(0)).words


def test_the_composed_table_says_what_the_transducers_say_one_after_the_other():
    states, moves, factors = toxicity.clause_transducer().table(6)
    r = random.Random(4)
    for _ in range(300):
        clause, at, factor = [r.randrange(6) for _ in range(r.randint(0, 12))], 0, 0.0
        scope, seen, plain = 0, set(), 0.0
        for x in clause:
            factor += factors[at][x]
            at = moves[at][x]
            plain += not (scope and x == toxicity.THREAT)
            seen.add((x, scope > 0) if x in (toxicity.INSULT, toxicity.THREAT) else x)
            scope = toxicity.NEGATION_SCOPE if x == toxicity.NEGATION else max(0, scope - 1)
        assert factor == plain
        insult = 2 if (toxicity.INSULT, False) in seen else 1 if (toxicity.INSULT, True) in seen else 0
        assert states[at] == (scope, toxicity.REPORT in seen, toxicity.TARGET in seen, (toxicity.THREAT, False) in seen, insult)


def test_clauses():
    g = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, 3.0), {"lowei": 4.0})
    name = lambda t: (g.clause(t.split()) or (None,))[0]
    assert name("what a moron") == "plain"
    assert name("you moron") == "targeted"
    assert name("you are not a moron") == "negated"
    assert name("he said moron") == "reported"
    assert name("i will kill you") == "threat"
    assert name("you i will kill") == "threat"
    assert name("moron i will kill you") == name("i will kill you moron") == "threat"
    assert name("i will not kill you") is None
    assert name("he said i will kill you") == "reported"
    # weights add along the path; a negated threat adds nothing
    assert g.clause("moron i will kill you".split())[1] == 6.0
    assert g.clause("you moron i do not kill".split())[1] == 3.0
    assert name("i will not kill you") is None
    assert name("a nice day") is None
    assert name("loweix") == "plain"
    assert name("lowei") is None
    assert g.features("A nice day. You moron! Fine")[1] == pytest.approx(math.log(4))


# --- SimHash -----------------------------------------------------------------------------------------------------------


def plain_fingerprint(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_simhash_components(spark, odd_docs, odd_rows, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    fps = [plain_fingerprint(t) for _, t, _ in odd_rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = rooted(pairs, range(len(fps)))
    least = {}
    for i, (d, _, _) in enumerate(odd_rows):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    want = [(d, f"{fps[i]:016x}", least.get(root[i])) for i, (d, _, _) in enumerate(odd_rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("bucket_rows", [8, 512])
def test_links_of_clustered_fingerprints(spark, bucket_rows):
    r = random.Random(1)
    centres = [r.getrandbits(64) for _ in range(4)]
    fps = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for c in centres for _ in range(120)}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    links = simhash.link_forest(spark.createDataFrame([(x,) for x in fps], "f long"), bucket_rows=bucket_rows)
    a = np.array(fps, np.int64).view(np.uint64)
    pairs = [(fps[i], fps[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= 3)]
    assert rooted([tuple(x) for x in links.collect()], fps) == rooted(pairs, fps)


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2040)]
    got = {x.node: x.root for x in components.components(spark.createDataFrame([*pairs, (7, None)], "a long, b long")).collect()}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == rooted(pairs, nodes)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_of_similar_documents(spark, odd_docs, no_docs):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [[word() for _ in range(300)] for _ in range(60)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(30):  # three words changed: a Jaccard similarity of about 0.9
        b = list(base[i])
        for k in r.sample(range(300), 3):
            b[k] = word()
        rows.append((100 + i, " ".join(b)))
    for i in range(30, 50):  # half of the words: about 0.3
        rows.append((100 + i, " ".join(base[i][:150] + [word() for _ in range(150)])))
    kept = {x.doc_id for x in simhash_groups.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {*range(60), *range(130, 150)}
    odd = simhash_groups.keep_one(odd_docs)
    assert odd.columns == odd_docs.columns
    out = odd.collect()
    assert sum(not (x.text or "").split() for x in out) == 1
    assert len({x.text for x in out}) == len(out)
    assert simhash_groups.keep_one(no_docs).count() == 0


def test_keep_one_against_exact_jaccard(spark):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    docs = []
    # appended words: s shared shingles of s + b, from well below to just below, at and above 0.8
    for s in (4, 5, 6, 8, 12, 20, 40, 48, 52, 56, 60, 64, 100, 200, 400):
        for share in (0.72, 0.76, 0.79, 0.8, 0.81, 0.84, 0.9):
            base = [word() for _ in range(s + 4)]
            docs += [base, base + [word() for _ in range(round(s / share) - s)]]
    sets = [{tuple(d[i : i + 5]) for i in range(len(d) - 4)} for d in docs]
    pairs = [(i, i + 1) for i in range(0, len(docs), 2) if len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) >= 0.8]
    assert 50 < len(pairs) < len(docs) // 2
    want = {n for n, root in rooted(pairs, range(len(docs))).items() if n == root}
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    got = {x.doc_id for x in simhash_groups.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got >= want  # nothing below 0.8 goes
    assert len(got - want) <= 1  # met with probability 0.999
    # ten words and one more
    ten = " ".join(docs[4][:10])
    assert simhash_groups.keep_one(spark.createDataFrame([(1, ten), (2, ten + " more")], "doc_id long, text string")).count() == 1


# --- mixing ------------------------------------------------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        left = want - sum(target.values())
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: 2.0 * sizes[s] for s in above}
        open_ -= above


def words(t):
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


@pytest.mark.parametrize("bucket_rows", [2, 4096])
def test_mixing(odd_docs, odd_rows, no_docs, bucket_rows):
    got = curriculum.mix(odd_docs, bucket_rows=bucket_rows).collect()
    sizes = collections.Counter()
    for _, t, s in odd_rows:
        sizes[s] += words(t)
    target = plain_targets(dict(sizes))
    of = {round(v, 6): s for s, v in target.items()}
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, words(t)) for i, t, _ in odd_rows)
    taken = collections.Counter()
    for r in got:
        s = min(of, key=lambda v: abs(v - r.target))
        assert abs(s - r.target) < 1e-3
        assert r.source_size == sizes[of[s]]
        assert 0 <= r.taken <= 2 * r.size
        taken[of[s]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = curriculum.mix(odd_docs.repartition(3), bucket_rows=bucket_rows).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    positions = [r.position for r in got if r.position is not None]
    assert positions == sorted(positions)
    assert all(0 <= p <= 1 for p in positions)
    assert curriculum.mix(no_docs).count() == 0


def test_mixed_rows(odd_docs):
    want = collections.Counter()
    for r in curriculum.planned(*[curriculum.sized(odd_docs, "doc_id", "text", "source")] * 2, 1.5, 2.0, 4096).collect():
        want[r.doc_id, r.src, r.size] += -(-r.taken // r.size) if r.size else 0
    rows = curriculum.mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns
    assert collections.Counter((r.doc_id, r.source, words(r.text)) for r in rows.collect()) == +want


def test_mixed_rows_equal_in_id_source_and_size(spark):
    """Rows without an id are told apart: no more of them than the target asks for, but for the last."""
    rows = [(None, f"word{i} b c d", "only") for i in range(40)]
    got = curriculum.mixed_rows(spark.createDataFrame(rows, "doc_id long, text string, source string"), bucket_rows=8).collect()
    assert len(got) == 60  # 150 % of 160 words
    assert max(collections.Counter(r.text for r in got).values()) == 2


# --- nearest neighbours ------------------------------------------------------------------------------------------------


def exact_neighbours(rows, k):
    out = []
    for q, x in rows:
        if q % 20 == 0:
            s = sorted(((-float(np.einsum("i,i->", x, y)), v) for v, y in rows if v != q))[:k]
            out += [(q, i + 1, v, -d) for i, (d, v) in enumerate(s)]
    return out


def test_nearest_with_ties_and_bad_rows(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 8)).round(3)
    x[40:90] = x[40]
    rows = [(i - 5, v.tolist()) for i, v in enumerate(x)]
    bad = [(400, None), (420, [0.0] * 8), (440, [1.0, None] + [0.0] * 6), (460, [float("nan")] * 8), (480, [float("inf")] * 8), (None, [1.0] * 8), (500, [1.0, 2.0]), (520, [])]
    df = spark.createDataFrame([(a, b, "z", 1, "y") for a, b in rows + bad], "vec_id long, embedding array<double>, list string, rb int, lists string").repartition(3)
    got = sorted(tuple(g) for g in spann.nearest(df).collect())
    want = sorted(exact_neighbours([(a, np.array(b)) for a, b in rows], 20))
    hits = {(a, v) for a, _, v, _ in got} & {(a, v) for a, _, v, _ in want}
    assert len(hits) >= 0.9 * len(want)
    whole = [q for q in {w[0] for w in want} if {(g[2]) for g in got if g[0] == q} == {w[2] for w in want if w[0] == q}]
    assert whole
    for q in whole:
        a, b = ([(g[1], g[2], round(g[3], 9)) for g in s if g[0] == q] for s in (got, want))
        assert a == b
    assert spann.nearest(df.limit(0)).count() == 0
    few = spark.createDataFrame(rows[4:8], "vec_id long, embedding array<double>")
    assert spann.nearest(few).count() == 3


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    t = df.toPandas()
    x, ids = np.stack(t.embedding.to_list()).astype(float), t.vec_id.to_numpy()
    got = collections.defaultdict(set)
    for r in spann.nearest(df).collect():
        got[r.query_id].add(r.vec_id)
    hit = n = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        hit, n = hit + len(got[ids[i]] & set(ids[np.argsort(-s)[:20]].tolist())), n + 20
    assert hit / n >= 0.9


def test_every_query_gets_k_rows(spark, monkeypatch):
    monkeypatch.setattr(spann, "LIST_ROWS", 4)
    r = np.random.default_rng(5)
    centre = r.normal(size=(60, 16))
    x = np.repeat(centre / np.linalg.norm(centre, axis=1)[:, None], 5, axis=0) + r.normal(size=(300, 16)) * 1e-4
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    # 200 rows of one id around a query
    rows += [(301, (x[0] + r.normal(size=16) * 1e-5).tolist()) for _ in range(200)]
    got = collections.Counter(g.query_id for g in spann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == dict.fromkeys(range(0, 300, 20), 20)


# --- repeated strings --------------------------------------------------------------------------------------------------


def plain_removal(rows):
    """rows: (order key, id, text)"""
    first, out = {}, {}
    for key, i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - 99):
            w = hashlib.md5(b[p : p + 100]).digest()
            if first.setdefault(w, (key, p)) != (key, p):
                cover[p : p + 100] = b"\1" * 100
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out[key] = (i, len(b), sum(cover), sum(1 for j in range(len(b)) if cover[j] and not (j and cover[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group_rows", [3, 64])
def test_repeats(spark, group_rows):
    r = random.Random(3)
    some = lambda n: " ".join(r.choice(["alpha", "be", "é", "zeta", "of"]) + str(r.randint(0, 99)) for _ in range(n))
    passages = [some(30) for _ in range(5)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(r.randint(0, 4)):
            parts.append(some(r.randint(1, 25)))
            if r.random() < 0.7:
                p, a = r.choice(passages), r.randint(0, 60)
                parts.append(p[a : a + r.randint(60, 200)])
        rows.append((i * 3 - 30, "".join(parts)))
    rows += [(5000, "ab" * 400), (5001, "ab" * 300), (5002, "x" * 99), (5003, "x" * 100), (5004, "x" * 101), (5005, None), (5006, ""), (7, rows[3][1])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), group_rows=group_rows).collect()
    assert sorted(map(tuple, got)) == sorted(plain_removal([(i, i, t) for i, t in rows]).values())


def test_repeats_of_one_very_common_gram(spark, monkeypatch):
    """Hundreds of classes of one gram over several buckets: a line between other words, and near copies with an edit anywhere."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 40)
    r = random.Random(5)
    some = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    line, passage = some(70), some(260)
    rows = []
    for i in range(500):
        a = r.randrange(len(passage))
        edited = passage[:a] + r.choice("xyz") + passage[a + r.randint(0, 1) :]
        rows.append((i, some(r.randint(0, 40)) + (line if i % 2 else edited) + some(r.randint(0, 40))))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), group_rows=8).collect()
    assert sorted(map(tuple, got)) == sorted(plain_removal([(i, i, t) for i, t in rows]).values())


def test_repeats_edges(spark, odd_docs, odd_rows, no_docs):
    got = sorted((tuple(x) for x in suffix_dedup.remove_repeats(odd_docs).collect()), key=repr)
    hashes = {t: h for t, h in odd_docs.select("text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    keyed = [((i is None, i or 0, hashes[t]), i, t) for i, t, _ in odd_rows]
    plain = plain_removal(set(keyed))
    assert got == sorted((plain[k] for k, _, _ in keyed), key=repr)
    out = suffix_dedup.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == len(odd_rows)
    assert all((r.text is None and r.n_chars is None) or r.n_chars == len(r.text) for r in out.collect())
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_multikey_order():
    r = np.random.default_rng(2)
    w = r.integers(0, 3, (500, 6)).astype(np.uint64)
    assert w[suffix_dedup.multikey_order(w)].tolist() == sorted(w.tolist())


# --- language model ----------------------------------------------------------------------------------------------------


def test_lm_scores(odd_docs, odd_rows, no_docs):
    got = ppm.score_texts(odd_docs, frequent_words=3).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter()
    for i, t, _ in odd_rows:
        if not held(i):
            c.update((t or "").encode().lower().split())
            c[" "] += 1
    n, v = sum(c.values()), len(c)
    want = []
    for i, t, _ in odd_rows:
        w = [*(t or "").encode().lower().split(), " "]
        want.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 5)))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 for r in got)
    assert ppm.score_texts(no_docs).count() == 0


def plain_ppm(train, order):
    counts = collections.defaultdict(collections.Counter)
    for t in train:
        s = b"\xff" * order + t + b"\xff"
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[s[i - k : i]][s[i]] += 1

    def p(ctx, sym):
        if ctx is None:
            return 1 / 256
        shorter = ctx[1:] if ctx else None
        if ctx not in counts:
            return p(shorter, sym)
        c = counts[ctx]
        n, q = sum(c.values()), len(c)
        if sym in c:
            return (2 * c[sym] - 1) / (2 * n)
        return q / (2 * n) * p(shorter, sym) / (1 - sum(p(shorter, x) for x in c))

    return lambda t: sum(math.log10(p(s[i - order : i], s[i])) for s in [b"\xff" * order + t + b"\xff"] for i in range(order, len(s)))


def test_long_texts_are_read_in_pieces(monkeypatch):
    r = random.Random(8)
    texts = [bytes(r.choice(b"abcd ") for _ in range(r.randint(0, 60))) for _ in range(30)]
    keys, n = np.unique(np.concatenate([k for _, _, k in ppm.batched(texts, 5)]), return_counts=True)
    entries = ppm.Entries(keys[n > 1], np.log10(n[n > 1] / 100).astype(np.float32), 5).ready()
    whole = entries.scores(texts)
    monkeypatch.setattr(ppm, "PIECE", 7)
    pieces = entries.scores(texts)
    assert pieces[0].tolist() == pytest.approx(whole[0].tolist())
    assert pieces[1] == whole[1]


@pytest.mark.parametrize(("order", "entries"), [(0, 10), (2, 0), (5, 40), (5, 1_000_000)])
def test_ppm_against_a_plain_one(spark, order, entries):
    """However many entries are broadcast."""
    r = random.Random(9)
    make = lambda: "".join(r.choice("abcd ") for _ in range(r.randint(0, 60)))
    rows = [(i, make()) for i in range(60)] + [(61, "zzz abc"), (62, ""), (63, None), (64, "zz")]
    got = ppm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), order=order, most_entries=entries).collect()
    plain = plain_ppm([(t or "").encode() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2], order)
    assert {x.doc_id: x.score for x in got} == {i: pytest.approx(plain((t or "").encode()), rel=1e-5) for i, t in rows}


def test_ppm_without_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = ppm.score_texts(spark.createDataFrame([(held, "abc")], "doc_id long, text string")).first()
    assert got.score == pytest.approx(-4 * math.log10(256))


def test_the_model_grows_with_the_corpus(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select(F.encode("text", "UTF-8").alias("t"))
    half, whole = (ppm.fit_model(d)[0].count() for d in (docs.limit(docs.count() // 2), docs))
    assert whole > 1.3 * half
