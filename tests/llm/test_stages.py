"""Each stage of the pipeline against a brute-force version, on its own input."""

import collections
import hashlib
import itertools
import re

import pytest

from unitflow.llm import bpe_chunks, curriculum, simhash_groups, token_count, toxicity
from unitflow.llm.common import table


def shingle_set(text, words=5):
    own = (text or "").encode().lower().split()
    return {b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else {b""}


def near_groups(docs, similarity=0.8):
    """The least id of each document's component, by the exact similarity of all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in docs}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    seen = set()
    for own in holders.values():
        for a, b in itertools.combinations(own, 2):
            if (a, b) not in seen and find(a) != find(b):
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in sets}


def test_near_duplicates_of_the_corpus(spark):
    """Recall and false removals on whole documents of the test data."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    groups = near_groups(rows)
    want = {i for i, g in groups.items() if i == g}
    got = {r.doc_id for r in simhash_groups.keep_one(docs).select("doc_id").collect()}
    assert len(rows) - len(want) > 50
    assert want <= got  # no false removal
    assert len(got - want) <= 1  # a pair at 0.8 is met with probability 0.999


@pytest.fixture(scope="module")
def stages(spark, small):
    import corpus_pipeline as cp

    out = [table(spark, small, "documents").cache()]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], small).cache())
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_toxicity_stage(spark, small, stages):
    grammar = toxicity.fit_grammar(stages[0], table(spark, small, "labels"))
    kept = [(i, t) for i, t in texts(stages[0]) if grammar.score(grammar.features(t or "")) < 0.3]
    assert texts(stages[1]) == kept
    assert len(kept) < stages[0].count()


def test_near_duplicate_stage(stages):
    groups = near_groups(texts(stages[1]))
    assert [i for i, _ in texts(stages[2])] == sorted(i for i, g in groups.items() if i == g)


def test_suffix_stage(stages):
    first, want = {}, []
    for i, t in texts(stages[2]):
        b = t.encode()
        cover = bytearray(len(b))
        for p in range(len(b) - 99):
            w = hashlib.md5(b[p : p + 100]).digest()
            if first.setdefault(w, (i, p)) != (i, p):
                cover[p : p + 100] = b"\1" * 100
        want.append((i, bytes(x for x, c in zip(b, cover, strict=True) if not c).decode("utf-8", "ignore")))
    assert texts(stages[3]) == want
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_mix_stage(stages):
    docs = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in stages[3].collect()]
    sizes = collections.Counter()
    for _, s, n in docs:
        sizes[s] += n
    taken = {r.doc_id: r.taken for r in curriculum.mix(stages[3]).collect()}
    got = collections.Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    assert got == collections.Counter({i: -(-taken[i] // n) for i, _, n in docs if n and taken[i]})
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=str.encode))}
    target, open_ = {}, set(sizes)
    while open_:
        left, total = 1.5 * sum(sizes.values()) - sum(target.values()), sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in above} if above else {s: left * weight[s] / total for s in open_}
        open_ -= above or open_
    for s, t in target.items():
        assert abs(sum(taken[i] for i, own, _ in docs if own == s) - t) <= 1


def test_bpe_stage(stages, tokenizer_path):
    t = token_count.encoder(tokenizer_path("word_bpe_49k.json"))
    want = sorted((i, t.encode(x, add_special_tokens=False).ids) for i, x in texts(stages[4]))
    got = stages[5].collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == want
    assert all(r.decoded == t.decode(list(r.ids), skip_special_tokens=False) for r in got)


def test_another_vocabulary_is_refused(tokenizer_path):
    with pytest.raises(ValueError, match="is asked for"):
        bpe_chunks.Coder(tokenizer_path("byte_bpe_50k.json"))


def test_long_words_are_not_kept(tokenizer_path):
    c = bpe_chunks.Coder(tokenizer_path("word_bpe_49k.json"))
    c.encode(b"short " + b"x" * 100_000)
    assert max(map(len, c.words)) <= bpe_chunks.LONGEST_WORD
    tiers = token_count.Tiers(tokenizer_path("byte_bpe_50k.json"), {})
    tiers.of("short " + "x" * 100_000 + " y")
    assert max(map(len, tiers.lengths)) <= token_count.LONGEST
