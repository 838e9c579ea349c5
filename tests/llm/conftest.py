import random

import pytest

#: Extra columns with names that the operators use inside.
CLASH = "t long, d string, th string, row string, src string, id string, node string, fp string, spans string, size string, bucket string, size_ long, doc string"


def word(r):
    return "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7)))


def text(r, n):
    return " ".join(word(r) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and white texts, repeated rows, ties, odd characters, a long text, extra columns with clashing names."""
    r = random.Random(7)
    base = [text(r, r.randint(5, 80)) for _ in range(25)]
    texts = base + [None, "", "   \n\t", "x", "é̀ ß İ ΑΣ 日本語 😀", "<|endoftext|> a <|startoftext|>", "a b  c\r\n\r\nd\x1ce", "don't I'LL HE'd 12 3²", text(r, 6000), base[0] + " more", base[1].upper(), "word " * 400, "q" * 3000, "A\x00b"]
    rows = [(i * 3 if i % 9 else None, t, ["s1", "s2", None, "é"][i % 4]) for i, t in enumerate(texts)]
    rows += [(3, base[1], "s2"), (3, base[1], "s2"), (3, base[2], "s1"), (None, base[4], None)]
    rows = [(a, b, "en", c, len(b) if b else None, 1, *["z"] * 10, 2, "z") for a, b, c in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(4)


@pytest.fixture(scope="session")
def odd_rows(odd_docs):
    return [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def tokenizer_path():
    from unitflow.llm.queries import tokenizer_file

    return tokenizer_file
