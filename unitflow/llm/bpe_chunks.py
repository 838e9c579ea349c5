"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last four bytes cuts a text where its top bits are zero, so equal passages give equal chunks in
any document. A worker encodes an equal chunk once. Cuts may fall inside a word: a chunk keeps the bytes before its first
and after its last white space as loose ends. At a join the loose ends are put together and encoded again, over as many
chunks as it takes to reach white space on both sides. The vocabulary's pre-tokenisation drops white space and matches
nothing across it, and ASCII white space neither composes nor reorders under NFC, so the result agrees with encoding the
whole text exactly. Inside a chunk the words, too, are kept in a cache. Both caches are bounded in bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text
from .token_count import byte_alphabet, encoder

#: Chunks have 2**CHUNK_BITS bytes on average. Longer words and chunks are not kept, and a cache that holds so many bytes begins anew.
CHUNK_BITS, LONGEST_CHUNK, LONGEST_WORD, CHUNK_BYTES, WORD_BYTES = 9, 8192, 64, 8_000_000, 20_000_000
#: About what an entry takes besides its bytes.
ENTRY_BYTES = 300
#: The normaliser and pre-tokeniser that the rules here hold for.
NORMALISERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FACTOR = np.uint32(0x9E3779B1)
#: Letters whose lower case is one letter in every library and which NFC leaves alone.
SIMPLE = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
#: Whole texts of which that holds, and a stop or comma that follows other punctuation.
PLAIN, CLOSE = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*"), re.compile(r"[^A-Za-z0-9\s\xc0-\xd6\xd8-\xf6\xf8-\xff][.,]\s")


class Words(dict):
    """A word's UTF-8 (no ASCII white space inside) to (ids as little-endian 32-bit, decoded UTF-8)."""

    def __init__(self, coder: Coder):
        self.coder, self.bytes = coder, 0

    def __missing__(self, word: bytes) -> tuple[bytes, bytes]:
        made = self.coder.encode_word(word)
        if len(word) <= LONGEST_WORD:
            self[word] = made
            self.bytes += ENTRY_BYTES + len(word) + len(made[0]) + len(made[1])
        return made


def refuse_others(spec: dict) -> None:
    """Raise unless the file drops white space, lower-cases and splits as this module takes for granted."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    replace = next((x for x in steps if x["type"] == "Replace"), {})
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = cuts[0] if cuts and cuts[0]["type"] == "Split" else {}
    fine = [x["type"] for x in steps] == NORMALISERS and replace["pattern"] == {"Regex": r"\s+"} and replace["content"] == " "
    fine = fine and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and split["pattern"] == {"Regex": SPLIT} and split["behavior"] == "Removed" and split["invert"]
    fine = fine and not cuts[1]["add_prefix_space"] and not (spec.get("decoder") or any(c.isspace() for x in spec["added_tokens"] for c in x["content"]))
    if not fine:
        raise ValueError("a vocabulary without a decoder, whose normaliser lower-cases and whose pre-tokeniser drops white space, is asked for")


class Coder:
    """One worker's encoder: the vocabulary, the cache of words and the cache of chunks."""

    def __init__(self, path: str):
        self.whole = encoder(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.marks = {x["content"][:2].lower().encode() for x in spec["added_tokens"]}
        self.names = {v: k.encode() for k, v in self.whole.get_vocab(with_added_tokens=True).items()}
        refuse_others(spec)
        self.fast = self.ranked(model)
        self.words, self.chunks, self.chunk_bytes = Words(self), {}, 0

    def ranked(self, model: dict):
        """An encoder for words of simple letters, if the merges are in the order of their ids: a word's last byte stands with the end-of-word suffix, as a byte value of its own."""
        import tiktoken

        suffix, vocab = model.get("end_of_word_suffix") or "", model["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made) or not suffix or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            return None
        letters = {b: c for c, b in byte_alphabet().items()}
        used = sorted({b for c in [*range(ord("a"), ord("z") + 1), *range(0xDF, 0xF7), *range(0xF8, 0x100)] for b in chr(c).encode()})
        free = [b for b in range(256) if b not in set(used)][: len(used)]
        self.last = dict(zip(used, (bytes([b]) for b in free), strict=True))
        code = {letters[b]: bytes([b]) for b in used} | {letters[b] + suffix: self.last[b] for b in used}
        ranks = {}
        for token, i in vocab.items():
            end = token.endswith(suffix) and token != suffix
            parts = list(token.removesuffix(suffix)) if end else list(token)
            if end:
                parts[-1] += suffix
            if all(p in code for p in parts):
                ranks[b"".join(code[p] for p in parts)] = i
        rest = (i for i in range(1 << 24, 1 << 25))
        for b in range(256):
            ranks.setdefault(bytes([b]), next(rest))  # each byte value needs a rank; these never occur
        return tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def encode_word(self, word: bytes) -> tuple[bytes, bytes]:
        text = word.decode("utf-8", "replace")
        if self.fast and SIMPLE.fullmatch(text):
            ids = self.fast(word[:-1] + self.last[word[-1]])
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes(), b" ".join([self.names[i] for i in ids])

    def canonical(self, text: bytes) -> bytes:
        """The same tokens with fewer different words: lower case, and white space before a single stop or comma that ends a word."""
        said = text.decode("utf-8", "replace")
        if any(x in text.lower() for x in self.marks) or not PLAIN.fullmatch(said):
            return text
        said = said.lower()
        if not CLOSE.search(said):
            said = said.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n").replace(",\n", " ,\n")
        return said.encode()

    def encode_run(self, run: bytes) -> tuple[bytes, bytes]:
        """Bytes that white space or the text's ends bound on both sides."""
        made = list(map(self.words.__getitem__, run.split()))
        return b"".join([x[0] for x in made]), b" ".join([x[1] for x in made if x[1]])

    def encode_chunk(self, chunk: bytes) -> tuple[bytes, tuple[bytes, bytes] | None, bytes]:
        """(loose bytes before the first white space, what lies between encoded, loose bytes after the last); None: no white space."""
        parts = chunk.split(None, 1)
        if len(parts) < 2 and len(chunk) == len(parts[0] if parts else b""):
            return chunk, None, b""
        head = b"" if chunk[:1].isspace() else parts[0]
        rest = chunk[len(head) :]
        tail = b"" if rest[-1:].isspace() else rest.rsplit(None, 1)[-1]
        return head, self.encode_run(rest[: len(rest) - len(tail)]), tail

    def cuts(self, text: bytes) -> list[int]:
        if len(text) < 64:
            return [0, len(text)]
        b = np.frombuffer(text, np.uint8)
        word = np.ndarray((len(b) - 3,), "<u4", b, 0, (1,))
        at = np.flatnonzero((word * FACTOR) >> np.uint32(32 - CHUNK_BITS) == 0) + 4
        return [0, *at[at < len(b)].tolist(), len(b)]

    def encode(self, text: bytes) -> tuple[bytes, bytes]:
        """(ids, decoded text) of a whole text."""
        if self.words.bytes > WORD_BYTES:
            self.words = Words(self)
        text = self.canonical(text)
        ids: list[bytes] = []
        said: list[bytes] = []

        def add(made: tuple[bytes, bytes]) -> None:
            if made[0]:
                ids.append(made[0])
                said.append(made[1])

        loose: list[bytes] = []
        cuts = self.cuts(text)
        for a, b in zip(cuts, cuts[1:], strict=False):
            chunk = text[a:b]
            key = hashlib.blake2b(chunk, digest_size=16).digest() if b - a > 48 else None
            if (made := self.chunks.get(key)) is None:
                made = self.encode_chunk(chunk)
                if key and b - a <= LONGEST_CHUNK:
                    if self.chunk_bytes > CHUNK_BYTES:
                        self.chunks, self.chunk_bytes = {}, 0
                    self.chunks[key] = made
                    self.chunk_bytes += ENTRY_BYTES + len(made[0]) + len(made[2]) + (len(made[1][0]) + len(made[1][1]) if made[1] else 0)
            head, body, tail = made
            loose.append(head)
            if body is not None:
                add(self.encode_run(b"".join(loose)))
                add(body)
                loose = [tail]
        add(self.encode_run(b"".join(loose)))
        return b"".join(ids), b" ".join(said)


def encode_texts(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and decoded (string) of every row.

    Null text is empty: no ids, an empty decoded text. A null id stays null; repeated rows each give a row; an empty table
    gives none; other columns are not read. Invalid UTF-8 cannot occur in a string column.
    """
    kind = df.schema[doc_id].dataType.simpleString()

    def fn(part: pa.RecordBatch, texts: list[bytes], state: Coder) -> pa.RecordBatch:
        made = [state.encode(x) for x in texts]
        ids = np.frombuffer(b"".join(x[0] for x in made), "<u4").astype(np.int32)
        ends = np.cumsum([0, *(len(x[0]) // 4 for x in made)])
        return pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), pa.array([x[1].decode() for x in made], pa.string())], ["doc_id", "ids", "decoded"])

    return map_text(df, [doc_id], text, fn, f"doc_id {kind}, ids array<int>, decoded string", lambda: Coder(path))


def encode_digests(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit) and decoded_sha256 of every row, without moving the ids. Nulls and ties as in encode_texts."""
    kind = df.schema[doc_id].dataType.simpleString()

    def fn(part: pa.RecordBatch, texts: list[bytes], state: Coder) -> pa.RecordBatch:
        made = [state.encode(x) for x in texts]
        sha = lambda k: pa.array([hashlib.sha256(x[k]).hexdigest() for x in made], pa.string())
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x[0]) // 4 for x in made], pa.int64()), sha(0), sha(1)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_text(df, [doc_id], text, fn, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", lambda: Coder(path))
