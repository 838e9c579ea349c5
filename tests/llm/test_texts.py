"""Operators on single texts against plain versions: token counts, BPE, licences, JPEG."""

import hashlib
import random
import struct
import re
import zlib

import numpy as np
import pytest

from unitflow.llm import bpe_chunks, jpeg, license_scan, token_count


def by_row(df):
    return sorted(((r.doc_id, *list(r)[1:]) for r in df.collect()), key=repr)


def test_token_counts(odd_docs, odd_rows, no_docs, tokenizer_path):
    path = tokenizer_path("byte_bpe_50k.json")
    t = token_count.encoder(path)
    want = []
    for i, x, _ in odd_rows:
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        want.append((i, len((x or "").encode()), n, n > 512))
    assert by_row(token_count.token_counts(odd_docs, path)) == sorted(want, key=repr)
    assert by_row(token_count.token_counts(odd_docs, path, table_entries=0)) == sorted(want, key=repr)
    assert token_count.token_counts(no_docs, path).count() == 0


def test_token_counts_of_random_texts(tokenizer_path):
    path = tokenizer_path("byte_bpe_50k.json")
    t, tiers, r = token_count.encoder(path), token_count.Tiers(path, {}), random.Random(3)
    for _ in range(1500):
        x = "".join(r.choice("ab \n\t.'sé1  漢<|") for _ in range(r.randint(0, 60)))
        assert tiers.of(x) == len(t.encode(x, add_special_tokens=False).ids), x


def test_bpe(odd_docs, odd_rows, no_docs, tokenizer_path):
    path = tokenizer_path("word_bpe_49k.json")
    t = token_count.encoder(path)
    want = []
    for i, x, _ in odd_rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        said = t.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    assert by_row(bpe_chunks.encode_digests(odd_docs, path)) == sorted(want, key=repr)
    assert bpe_chunks.encode_digests(no_docs, path).count() == 0
    for r in bpe_chunks.encode_texts(odd_docs, path).collect():
        assert r.decoded == t.decode(list(r.ids), skip_special_tokens=False)


def test_bpe_of_random_texts_and_a_real_sample(spark, small, tokenizer_path):
    path = tokenizer_path("word_bpe_49k.json")
    t, coder, r = token_count.encoder(path), bpe_chunks.Coder(path), random.Random(4)
    texts = ["".join(r.choice("abAB \n.,'tsÉé1́ 漢<|J̌") for _ in range(r.randint(0, 200))) for _ in range(1500)]
    texts += [x.text for x in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        got, said = coder.encode(x.encode())
        assert got == np.array(ids, "<u4").tobytes(), x[:200]
        assert said.decode() == t.decode(ids, skip_special_tokens=False)


def test_equal_passages_give_equal_chunks(tokenizer_path):
    coder, r = bpe_chunks.Coder(tokenizer_path("word_bpe_49k.json")), random.Random(5)
    passage = " ".join(str(r.random()) for _ in range(400)).encode()
    a, b = (coder.cuts(x) for x in (b"one " + passage, b"another beginning " + passage))
    chunks = lambda cuts, x: {x[i:j] for i, j in zip(cuts, cuts[1:], strict=False)}
    assert len(chunks(a, b"one " + passage) & chunks(b, b"another beginning " + passage)) >= len(a) - 4


def plain_places(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = []
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(found)


LICENSED = ["x Licensed under CC BY-NC 4.0. y", "GNU general-public LICENSE; the gnu General Public License", "MIT License mit license", "apache license cc by by cc apache", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"]


def test_licences(spark, odd_docs, odd_rows, no_docs):
    extra = spark.createDataFrame([(900 + i, t) for i, t in enumerate(LICENSED)], "doc_id long, text string")
    df = odd_docs.select("doc_id", "text").unionByName(extra)
    got = license_scan.scan_licences(df).collect()
    rows = [(a, b) for a, b, _ in odd_rows] + [(900 + i, t) for i, t in enumerate(LICENSED)]
    want = []
    for i, t in rows:
        n, found = plain_places(t)
        want.append((i, n, len(found), found[0][0] if found else None, found[-1][0] if found else None, ",".join(sorted({x[1] for x in found}))))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == sorted(want, key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert "isc" in {r.doc_id: r.labels for r in got}[904]
    assert license_scan.scan_licences(no_docs).count() == 0
    assert license_scan.scan_licences(odd_docs).columns[0] == "doc_id"


def test_automaton_finds_every_maximal_match():
    r = random.Random(6)
    templates = [[r.randint(0, 3) for _ in range(12)] for _ in range(4)]
    a = license_scan.Automaton(templates, 2)
    held = lambda x: any(x == t[i : i + len(x)] for t in templates for i in range(len(t)))
    for _ in range(60):
        s = [r.randint(-1, 3) for _ in range(40)]
        longest = [max((n for n in range(1, len(s) - i + 1) if held(s[i : i + n])), default=0) for i in range(len(s))]
        # no match of an earlier word reaches as far
        want = {(i, n) for i, n in enumerate(longest) if n >= 2 and (not i or longest[i - 1] - 1 < n)}
        got = a.matches(s)
        assert {(i, n) for i, n, _ in got} == want
        for m in got:
            places = a.places(*m)
            whole = {(k, p) for k, t in enumerate(templates) for p in range(len(t)) if t[p : p + m[1]] == s[m[0] : m[0] + m[1]]}
            assert {(k, p) for k, _, n, p in places if n == m[1]} == whole
            for k, t in enumerate(templates):  # else the longest end of the match that the template has
                ends = [n for n in range(2, m[1] + 1) if any(t[p : p + n] == s[m[0] + m[1] - n : m[0] + m[1]] for p in range(len(t)))]
                assert {n for j, _, n, _ in places if j == k} == ({max(ends)} if ends else set())


def plain_best(matches, gap):
    """The largest number of words that a chain from each first match covers, by trying all."""
    best = {}

    def go(root, covered, last):
        best[root] = max(best.get(root, 0), covered)
        a, m, p = last
        for first, n, place in matches:
            over = max(0, a + m - first)
            if (first + n, first, place) > (a + m, a, p) and a < first and over < n and a + m >= first - gap and p + m <= place + over:
                go(root, covered + n - over, (first, n, place))

    for x in matches:
        go(x, x[1], x)
    return max(best.values())


def test_chains_cover_most():
    r = random.Random(12)
    for _ in range(200):
        ends = sorted(r.sample(range(3, 60), r.randint(1, 7)))
        matches = [(e - n, n, r.randint(0, 20)) for e in ends for n in [r.randint(2, min(e, 8))]]
        chains = license_scan.chained(matches, 6)
        assert max(sum(n for _, n, _ in c) for c in chains) == plain_best(matches, 6)
        for c in chains:
            assert all(a + n <= b and p + n <= q and b - a - n <= 6 for (a, n, p), (b, _, q) in zip(c, c[1:], strict=False))


def test_licence_labels(spark):
    told = {
        "This work is licensed under the GNU General Public License version 2": "gpl,gpl-2.0",
        "It is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "licensed under the GNU General Public License version 4": "gpl",
        "the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License": "lgpl-2.1",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
        "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa-4.0",
        "Licensed under CC BY 3.0.": "cc-by,cc-by-3.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons licence": "",
        "Licensed under the Apache License, Version 2.0": "apache,apache-2.0",
        "the software is provided as is": "",
        license_scan.WORDINGS["mit"].split("|")[1].replace("sublicense", "sub-license").replace("so subject", "so, always, subject"): "mit",
        license_scan.WORDINGS["isc"].upper(): "isc",
        "nothing of the kind": "",
    }
    rows = [(i, t) for i, t in enumerate(told)]
    got = license_scan.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {t: next(g.labels for g in got if g.doc_id == i) for i, t in rows} == told
    spans = license_scan.Scanner({}, license_scan.usual_templates()).scan(b"x y " + b" and ".join([b"licensed under cc by 4.0"] * 3))[2]
    assert [(s, e) for _, s, e, _, _ in spans] == [(2, 8), (9, 15), (16, 22)]


def test_one_word_phrases_count(spark):
    df = spark.createDataFrame([(1, "free as in beer, free"), (2, "no")], "doc_id long, text string")
    got = license_scan.scan_licences(df, base={"free": "f"}).orderBy("doc_id").collect()
    assert [(r.n_base, r.first_word, r.last_word) for r in got] == [(2, 0, 4), (0, None, None)]


def test_media(odd_docs, odd_rows, no_docs):
    got = jpeg.media_features(odd_docs).collect()
    want = []
    for i, t, _ in odd_rows:
        b = (t or "").encode()
        p = b + b" " * (max(192, -(-len(b) // 192) * 192) - len(b))
        want.append((i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    assert sorted(((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got), key=repr) == sorted(want, key=repr)
    media = {r.doc_id: bytes(r.media) for r in jpeg.with_media(odd_docs).collect()}
    assert all(hashlib.sha256(media[r.doc_id]).hexdigest() == r.media_sha256 for r in got if r.doc_id not in (None, 3))
    assert jpeg.media_features(no_docs).count() == 0


@pytest.mark.parametrize("n", [192, 384, 192 * 8191, 192 * 8192, 192 * 20001, 192 * 77])
def test_images_are_lossless(n):
    p = random.Random(n).randbytes(n)
    images = jpeg.read_media(jpeg.write_media(p))
    assert b"".join(t.tobytes() for t in images) == p


def test_feature_covers_every_image():
    r = np.random.default_rng(3)
    one = r.integers(32, 127, jpeg.MAX_ROWS * jpeg.UNIT + 192 * 40, dtype=np.uint8)
    two = one.copy()
    two[jpeg.MAX_ROWS * jpeg.UNIT :] = two[: jpeg.MAX_ROWS * jpeg.UNIT - 1 : -1]
    a, b = jpeg.stored([one.tobytes(), two.tobytes()])
    assert a[0] == a[1] == b[1] == len(one)
    assert a[6] != b[6]
    assert a[6].startswith("2:1536x65528:")
    assert ":1536x320:" in a[6]


def plain_hash(rows, columns, p):
    """The feature's hash, pixel by pixel."""
    x = [[p[y * columns + c] for c in range(columns)] for y in range(rows)]
    if rows < 8:
        x = [row for row in x for _ in range(-(-8 // rows))][:8]
        rows = 8
    out = 0
    for k in range(8):
        own = x[k * rows // 8 : (k + 1) * rows // 8]
        edges = [j * columns // 9 for j in range(10)]
        means = [sum(sum(row[a:b]) for row in own) / (b - a) for a, b in zip(edges, edges[1:], strict=False)]
        for a, b in zip(means, means[1:], strict=False):
            out = out << 1 | (b > a)
    return f"{out:016x}"


@pytest.mark.parametrize("n", [192, 192 * 7, 192 * 50, 192 * 4 * 400])
def test_feature_against_a_plain_version(n):
    p = random.Random(n).randbytes(n)
    columns, rows = jpeg.shape(n)
    assert jpeg.stored([p])[0][6] == f"1:{columns * 8}x{rows * 8}:{plain_hash(rows, columns, p)}"


def test_stored_texts_do_not_depend_on_their_batch():
    r = random.Random(1)
    texts = [r.randbytes(r.choice([0, 5, 191, 192, 193, 5000])) for _ in range(40)]
    assert jpeg.stored(texts) == [x for t in texts for x in jpeg.stored([t])]


def test_damaged_data_are_refused():
    whole = jpeg.write_media(random.Random(2).randbytes(192 * 4))
    at = whole.index(b"\xff\xd0")
    for bad in (whole[:-2], whole[:-60], whole[: at - 20] + whole[at:], whole[:at] + b"\xff\xd9", whole[1:]):
        with pytest.raises(ValueError, match="early|missing|word|start"):
            jpeg.read_media(bad)
    scan = whole.index(b"\x3f\x00") + 2
    no_runs = whole.replace(jpeg.segment(0xDD, struct.pack(">H", 192)), b"")
    with pytest.raises(ValueError, match="early"):  # bit by bit
        jpeg.read_media(no_runs[: scan + 30] + b"\xff\xd9")


def coded(blocks, components, restart=0, size=(16, 16)):
    """A small baseline file with ordinary Huffman tables, AC coefficients and restarts, written bit by bit."""
    import struct

    dc = (bytes([0, 1, 5, 1, 1, 1, 1, 1, 1] + [0] * 7), bytes(range(12)))
    ac = (bytes([0, 2, 1] + [0] * 13), bytes([0x00, 0x01, 0x12]))
    words = [{s: (w, n) for s, w, n in jpeg.huffman_words(*t)} for t in (dc, ac)]
    out, bits, last = b"", "", [0] * len(components)

    def flush():
        nonlocal out, bits
        bits += "1" * (-len(bits) % 8)
        out += int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00") if bits else b""
        bits = ""

    for k, (c, v) in enumerate(blocks):
        per = sum(h * w for h, w in components)
        if restart and k and k % (restart * per) == 0:
            flush()
            out += bytes([0xFF, 0xD0 + (k // (restart * per) - 1) % 8])
            last = [0] * len(components)
        d, last[c] = v - last[c], v
        s = abs(d).bit_length()
        w, n = words[0][s]
        bits += f"{w:0{n}b}" + (f"{d if d > 0 else d + (1 << s) - 1:0{s}b}" if s else "")
        for sym, extra in ((0x01, "1"), (0x12, "10"), (0x00, "")):
            w, n = words[1][sym]
            bits += f"{w:0{n}b}" + extra
    flush()
    sof = struct.pack(">BHHB", 8, size[1], size[0], len(components)) + b"".join(bytes([i + 1, h << 4 | w, 0]) for i, (h, w) in enumerate(components))
    sos = bytes([len(components)]) + b"".join(bytes([i + 1, 0]) for i in range(len(components))) + b"\x00\x3f\x00"
    parts = [b"\xff\xd8", jpeg.segment(0xDB, b"\x00" + bytes([16] * 64)), jpeg.segment(0xC0, sof), jpeg.segment(0xC4, b"\x00" + dc[0] + dc[1]), jpeg.segment(0xC4, b"\x10" + ac[0] + ac[1])]
    parts += [jpeg.segment(0xDD, restart.to_bytes(2, "big"))] if restart else []
    return b"".join([*parts, jpeg.segment(0xDA, sos), out, b"\xff\xd9"])


@pytest.mark.parametrize("restart", [0, 1, 3])
def test_general_scans(restart):
    r = random.Random(restart)
    one = [r.randint(-63, 63) for _ in range(12)]
    t = jpeg.read_media(coded([(0, v) for v in one], [(1, 1)], restart, (32, 24)))[0]
    assert t.tolist() == (np.clip(np.array(one) * 2 + 128, 0, 255)).reshape(3, 4).tolist()
    luma = [[r.randint(-63, 63) for _ in range(4)] for _ in range(4)]
    blocks = [b for mcu in luma for b in [(0, v) for v in mcu] + [(1, 5), (2, -5)]]
    t = jpeg.read_media(coded(blocks, [(2, 2), (1, 1), (1, 1)], restart, (32, 32)))[0]
    want = np.zeros((4, 4), int)
    for k, mcu in enumerate(luma):
        want[k // 2 * 2 : k // 2 * 2 + 2, k % 2 * 2 : k % 2 * 2 + 2] = np.array(mcu).reshape(2, 2) * 2 + 128
    assert t.tolist() == want.tolist()
