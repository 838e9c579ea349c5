"""Token counts by a two-tier look-up of pre-token lengths (no pre-token is shuffled).

Tier one: a compact table of frequent pre-tokens and their numbers of tokens, broadcast; ``table_entries`` bounds its
size. Tier two: a cache in each worker, filled by encoding what misses. Which entries either tier holds decides speed
only, never a count.

Pieces are cut before white space that follows something else. The vocabulary's pre-tokenisation always starts a new
pre-token there and looks at nothing before it, so the sum over pieces is the count of the whole text. Of several white
spaces the last goes with what follows and the others are a piece of their own, as in the pre-tokeniser's pattern. Texts with
white space other than spaces and line feeds are encoded whole.
"""

from __future__ import annotations

import json
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, map_text, quoted

#: Pre-tokenisation of the byte-level vocabularies (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TABLE_ENTRIES, SAMPLE_ROWS = 50_000, 2_000
#: Longer pieces are encoded each time; a cache of so many entries begins anew, so it has some 50 MB at most.
LONGEST, CACHE_ENTRIES = 48, 300_000
#: Spaces and line feeds in a row.
RUNS = re.compile("[ \n](?=[^ \n])[^ \n]+|[^ \n]+|[ \n]+(?=[ \n][^ \n])|[ \n]+")
#: White space other than the space and the line feed.
ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Characters that every regex library puts in the same class; pieces with others go to the reference encoder.
PLAIN = re.compile("[\x00-\u024f]*")


def encoder(path: str):
    """The tokenizer of ``path``, without truncation or padding."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def fast_encoder(path: str):
    """The same vocabulary as ranks, if the file is a byte-level BPE whose merges are in the order of their ids; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
        return None
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(made):
        return None
    alphabet, special = byte_alphabet(), {x["content"] for x in spec["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in k): v for k, v in model["vocab"].items() if k not in special}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str) -> tuple[str, list[str], list[str]] | None:
    """(first piece, further pieces, pieces of white space only) of a text without odd white space, else None.

    A further piece begins with a line feed, or else with the space that is left out here.
    """
    if ODD_SPACE.search(text):
        return None
    cut = text.replace("\n", " \n").split(" ")
    if "" not in cut and "\n" not in cut:
        return cut[0], cut[1:], []
    cut = RUNS.findall(text)
    first = cut.pop(0) if cut and cut[0][0] not in " \n" else ""
    blank = [p for p in cut if not p.strip(" \n")]
    return first, [p if p[0] == "\n" else p[1:] for p in cut if p.strip(" \n")], blank


def frequent_table(df: DataFrame, text: str, path: str, entries: int = TABLE_ENTRIES, rows: int = SAMPLE_ROWS, doc_id: str = "doc_id") -> dict[str, int]:
    """Lengths of at most ``entries`` pieces that are frequent in about ``rows`` texts from all over the table (a warm-up of the cache, see the module)."""
    c = F.col(quoted(text)).cast("string")
    count: Counter[str] = Counter()
    some = df.select(F.col(quoted(doc_id)).cast("string").alias("i"), c.alias("t")).where(F.length(c).between(1, 20_000))
    for r in hash_sample(some, "i", rows, df.count()).limit(rows).collect():
        count.update((pieces(r.t) or ("", [], []))[1])
    tiers = Tiers(path, {})
    return {w: tiers.lengths[w] for w, _ in count.most_common(entries) if len(w) <= LONGEST}


class Lengths(dict):
    """Piece (not a first one) to number of tokens."""

    def __init__(self, table: dict[str, int], count):
        super().__init__(table)
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece if piece[0] == "\n" else " " + piece)
        if len(piece) <= LONGEST:
            self[piece] = n
        return n


class Tiers:
    def __init__(self, path: str, table: dict[str, int]):
        self.whole, self.fast, self.table = encoder(path), fast_encoder(path), table
        self.special = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.lengths = Lengths(table, self.exact)

    def exact(self, text: str) -> int:
        if self.fast and PLAIN.fullmatch(text):
            return len(self.fast.encode_ordinary(text))
        return len(self.whole.encode(text, add_special_tokens=False).ids)

    def of(self, text: str) -> int:
        if not text:
            return 0
        if any(s in text for s in self.special):
            return len(self.whole.encode(text, add_special_tokens=False).ids)
        if (cut := pieces(text)) is None or not self.fast:
            return self.exact(text)
        if len(self.lengths) > CACHE_ENTRIES:
            self.lengths = Lengths(self.table, self.exact)
        first, rest, blank = cut
        return (self.exact(first) if first else 0) + sum(map(self.lengths.__getitem__, rest)) + sum(map(self.exact, blank))


def token_counts(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 512, table_entries: int = TABLE_ENTRIES) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row.

    Null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows and ids each give a row; an empty
    table gives no rows; other columns are not read. ``path`` must be readable on every executor.
    """
    shared = df.sparkSession.sparkContext.broadcast(frequent_table(df, text, path, table_entries, doc_id=doc_id))
    kind = df.schema[doc_id].dataType.simpleString()

    def start():
        return Tiers(path, shared.value)

    def fn(part: pa.RecordBatch, texts: list[bytes], state: Tiers) -> pa.RecordBatch:
        n = [state.of(x.decode("utf-8", "replace")) for x in texts]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_text(df, [doc_id], text, fn, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", start)
