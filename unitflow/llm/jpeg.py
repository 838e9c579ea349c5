"""Baseline JPEG media columns: a lossless DC-only writer and a reader that reconstructs DC-only luminance thumbnails, in numpy.

Writer: each sample becomes one flat 8x8 block. With a quantiser of 8 the DC coefficient of a flat block is the sample
less 128, exactly, so the thumbnail of DC values is the payload. DC differences are Huffman-coded with the usual luminance table
(words of 2 to 9 bits), each block ends with the end-of-block word, and every INTERVAL blocks a restart marker begins a new run.

Reader: parses the markers, builds the Huffman tables from the file and decodes the scan to DC values, passing over AC
coefficients. The runs between restart markers are independent, so those of all images of a batch are decoded side by side,
block by block, by look-up on the next 16 bits; other scans (several components, no restarts) are read bit by bit. Data that
end early, a missing run, a word that no table has or a coefficient beyond the block's end raise ValueError. The thumbnail has one pixel
a luminance block.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text

UNIT = 192
#: Blocks in a row and rows of an image; 65535 pixels a side are the format's limit.
MAX_COLUMNS, MAX_ROWS = 8064, 8191


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def huffman_words(counts: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """(symbol, word, bits) by the canonical rule: words of a length count up, and double with each further bit."""
    out, word, k = [], 0, 0
    for bits in range(1, 17):
        for _ in range(counts[bits - 1]):
            out.append((symbols[k], word, bits))
            word, k = word + 1, k + 1
        word <<= 1
    return out


#: The usual Huffman table of luminance DC differences (ITU-T T.81, K.3).
DC_COUNTS, DC_SYMBOLS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]), bytes(range(12))
#: One word, "0", for the end of a block.
AC_COUNTS, AC_SYMBOLS = bytes([1] + [0] * 15), bytes([0])
INTERVAL = UNIT


def block_words() -> tuple[np.ndarray, np.ndarray]:
    """The bits of a block, and how many, by its DC difference + 255."""
    words = {s: (w, n) for s, w, n in huffman_words(DC_COUNTS, DC_SYMBOLS)}
    out, size = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        w, n = words[s]
        out[d + 255] = ((w << s) | (d if d >= 0 else d + (1 << s) - 1)) << 1
        size[d + 255] = n + s + 1
    return out, size


BLOCKS, BLOCK_BITS = block_words()


def shape(n: int) -> tuple[int, int]:
    """Columns and rows of blocks for n samples, a multiple of UNIT that one image can hold."""
    columns = UNIT
    while n // columns > MAX_ROWS or (n // columns > 4 * columns and n % (2 * columns) == 0 and 2 * columns <= MAX_COLUMNS):
        columns = next(c for c in range(columns + UNIT, MAX_COLUMNS + 1, UNIT) if n % c == 0)
    return columns, n // columns


def pieces(n: int) -> list[int]:
    """Sizes of the images that hold n samples: one unless it would be too large for the format."""
    most = MAX_ROWS * UNIT
    return [n] if n <= most else [most] * (n // most) + ([n % most] if n % most else [])


def write_runs(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scan data of all runs (INTERVAL samples each), stuffed, one after the other; and where each begins, with the end last."""
    runs = samples.reshape(-1, INTERVAL).astype(np.int16)
    which = np.diff(runs, axis=1, prepend=np.int16(128)) + 255
    word, size = BLOCKS[which], BLOCK_BITS[which]
    bits = size.sum(1)
    fill = -bits % 8  # ones up to the byte
    word = np.concatenate([word, ((1 << fill) - 1).astype(np.uint64)[:, None]], 1).reshape(-1)
    size = np.concatenate([size, fill[:, None]], 1).reshape(-1)
    at = np.cumsum(size) - size
    # a word lies in one or two 32-bit units; words of a unit stand together and share no bit
    both = word << (np.uint64(64) - (at & 31).astype(np.uint64) - size.astype(np.uint64)) % np.uint64(64)
    unit = at >> 5
    first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    out = np.zeros(int(unit[-1]) + 2, np.uint64)
    out[unit[first]] = np.add.reduceat(both >> np.uint64(32), first)
    out[unit[first] + 1] += np.add.reduceat(both & np.uint64(0xFFFFFFFF), first)
    plain = out.astype(">u4").view(np.uint8)[: int(bits.sum() + fill.sum()) // 8]
    full = plain == 0xFF  # a zero byte follows
    to = np.arange(len(plain)) + np.cumsum(full) - full
    data = np.zeros(len(plain) + int(full.sum()), np.uint8)
    data[to] = plain
    start = np.concatenate([[0], np.cumsum((bits + fill) // 8)])
    return data, start + np.concatenate([[0], np.cumsum(full)])[start]


def write_images(payloads: list[bytes]) -> list[bytes]:
    """Each payload (its size a multiple of UNIT) as images, one after the other."""
    sizes = [pieces(len(p)) for p in payloads]
    data, start = write_runs(np.frombuffer(b"".join(payloads), np.uint8))
    out, at = [], 0
    for own in sizes:
        parts = []
        for n in own:
            columns, rows = shape(n)
            runs = n // INTERVAL
            parts += [
                b"\xff\xd8",
                segment(0xE0, b"JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00"),
                segment(0xDB, b"\x00" + bytes([8] * 64)),
                segment(0xC0, struct.pack(">BHHBBBB", 8, rows * 8, columns * 8, 1, 1, 0x11, 0)),
                segment(0xC4, b"\x00" + DC_COUNTS + DC_SYMBOLS),
                segment(0xC4, b"\x10" + AC_COUNTS + AC_SYMBOLS),
                segment(0xDD, struct.pack(">H", INTERVAL)),
                segment(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
            ]
            for k in range(runs):
                parts.append(data[start[at + k] : start[at + k + 1]].tobytes())
                parts.append(bytes([0xFF, 0xD0 + k % 8 if k < runs - 1 else 0xD9]))
            at += runs
        out.append(b"".join(parts))
    return out


def padded(text: bytes) -> bytes:
    """The text and bytes 32 up to a positive multiple of UNIT."""
    return text + b" " * (-len(text) % UNIT if text else UNIT)


def write_media(payload: bytes) -> bytes:
    return write_images([payload])[0]


class Bits:
    """Bit reader over scan data without stuffing."""

    def __init__(self, data: bytes):
        self.data, self.at, self.value, self.left = data, 0, 0, 0

    def need(self, n: int) -> None:
        while self.left < n:
            if self.at >= len(self.data):
                raise ValueError("the scan ends early")
            self.value = (self.value << 8) | self.data[self.at]
            self.at, self.left = self.at + 1, self.left + 8

    def take(self, n: int) -> int:
        self.need(n)
        self.left -= n
        out = self.value >> self.left
        self.value &= (1 << self.left) - 1
        return out

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        word = 0
        for n in range(1, 17):
            word = (word << 1) | self.take(1)
            if (n, word) in table:
                return table[n, word]
        raise ValueError("no such Huffman word")


def extended(v: int, s: int) -> int:
    return v if not s or v >> (s - 1) else v - (1 << s) + 1


class Image:
    """Markers of one baseline image from ``data[at:]``; ``end`` is where the next may begin."""

    def __init__(self, data: bytes, at: int = 0):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError("no start of image")
        self.quant, self.tables, self.restart, self.parts = {}, {}, 0, []
        at += 2
        while True:
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xC0:
                self.height, self.width, n = struct.unpack(">HHB", body[1:6])
                self.parts = [(c, hv >> 4, hv & 15, q) for c, hv, q in zip(body[6::3][:n], body[7::3][:n], body[8::3][:n], strict=True)]
            elif marker in range(0xC1, 0xD0) and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not a baseline image")
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.tables[body[0]] = (body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.restart = int.from_bytes(body[:2], "big")
            elif marker == 0xDA:
                self.chosen = {c: t for c, t in zip(body[1::2][: body[0]], body[2::2][: body[0]], strict=True)}
                break
        self.scan_at, stop = at, at
        while True:  # FF 00 is a stuffed byte, FF D0 to D7 a restart
            stop = data.find(b"\xff", stop)
            if not 0 <= stop < len(data) - 1:
                raise ValueError("the scan ends early")
            if data[stop + 1] == 0 or 0xD0 <= data[stop + 1] <= 0xD7:
                stop += 2
            else:
                break
        self.scan = data[at:stop]
        self.end = stop + 2 if data[stop + 1] == 0xD9 else stop

    def side_by_side(self) -> bool:
        """One component in runs."""
        return len(self.parts) == 1 and self.restart > 0

    def size(self) -> tuple[int, int]:
        """Columns and rows of luminance blocks."""
        _, h, v, _ = self.parts[0]
        top_h, top_v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        if len(self.parts) == 1:
            return -(-self.width // 8), -(-self.height // 8)
        return -(-(-(-self.width * h // top_h)) // 8), -(-(-(-self.height * v // top_v)) // 8)

    def pixels(self, dc: np.ndarray) -> np.ndarray:
        """Luminance, one 8-bit pixel a block, of the DC values."""
        columns, rows = self.size()
        return np.clip((dc.reshape(rows, columns) * self.quant[self.parts[0][3]] + 4) // 8 + 128, 0, 255).astype(np.uint8)

    def thumbnail(self) -> np.ndarray:
        if self.side_by_side():
            return thumbnails([self])[0]
        columns, rows = self.size()
        return self.pixels(self.general(columns, rows, max(p[1] for p in self.parts), max(p[2] for p in self.parts)))

    def general(self, columns: int, rows: int, top_h: int, top_v: int) -> np.ndarray:
        tables = {k: {(n, w): s for s, w, n in huffman_words(*t)} for k, t in self.tables.items()}
        if len(self.parts) == 1:
            across, down, sampling = columns, rows, [(1, 1)]
        else:
            across, down = -(-self.width // (8 * top_h)), -(-self.height // (8 * top_v))
            sampling = [(p[1], p[2]) for p in self.parts]
        out = np.zeros((down * sampling[0][1], across * sampling[0][0]), np.int32)
        runs, at = [], 0
        while self.restart and at < len(self.scan):  # restart markers split the scan
            stop = at
            while (stop := self.scan.find(b"\xff", stop)) >= 0 and self.scan[stop + 1] == 0:
                stop += 2
            runs.append(self.scan[at : stop if stop >= 0 else len(self.scan)])
            at = stop + 2 if stop >= 0 else len(self.scan)
        runs = runs or [self.scan]
        unit, total = 0, across * down
        if len(runs) != (-(-total // self.restart) if self.restart else 1):
            raise ValueError("a run is missing")
        for run in runs:
            bits, last = Bits(run.replace(b"\xff\x00", b"\xff")), [0] * len(self.parts)
            for _ in range(min(self.restart or total, total - unit)):
                for k, (p, (h, v)) in enumerate(zip(self.parts, sampling, strict=True)):
                    t = self.chosen[p[0]]
                    for y in range(v):
                        for x in range(h):
                            s = bits.symbol(tables[t >> 4])
                            last[k] += extended(bits.take(s), s)
                            place = 1
                            while place < 64:
                                r = bits.symbol(tables[16 | (t & 15)])
                                if r == 0:
                                    break
                                bits.take(r & 15)
                                place += (r >> 4) + 1
                                if place > 64:
                                    raise ValueError("a coefficient stands beyond the block")
                            if k == 0:
                                out[unit // across * v + y, unit % across * h + x] = last[0]
                unit += 1
        return out[:rows, :columns]


_looked: dict[tuple[bytes, bytes], np.ndarray] = {}


def look_up(counts: bytes, symbols: bytes) -> np.ndarray:
    """By the next 16 bits: symbol * 32 + bits of its word; 0 where no word begins so."""
    if (counts, symbols) not in _looked:
        table = np.zeros(1 << 16, np.int32)
        for s, word, bits in huffman_words(counts, symbols):
            table[word << (16 - bits) : (word + 1) << (16 - bits)] = s * 32 + bits
        if len(_looked) > 64:
            _looked.clear()
        _looked[counts, symbols] = table
    return _looked[counts, symbols]


def unstuffed(scan: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a scan without markers and stuffed zeros, and where each run begins, with the end last."""
    b = np.frombuffer(scan, np.uint8)
    after = np.flatnonzero(b[:-1] == 0xFF) + 1
    marker = after[b[after] != 0]
    out = np.ones(len(b), bool)
    out[after] = False
    out[marker - 1] = False
    kept = np.concatenate([[0], np.cumsum(out)])
    return b[out], np.concatenate([[0], kept[marker], kept[-1:]])


def decoded_runs(data: np.ndarray, start: np.ndarray, blocks: np.ndarray, dc: np.ndarray, ac: np.ndarray) -> np.ndarray:
    """DC values of all runs, one after the other: run i's bits begin at byte start[i], and it has blocks[i] blocks."""
    wide = np.zeros(len(data) + 8, np.uint64)
    wide[: len(data)] = data
    window = np.zeros(len(data) + 1, np.uint64)  # the 32 bits from each byte on
    for k in range(4):
        window |= wide[k : k + len(window)] << np.uint64(24 - 8 * k)
    at, stop = start[:-1].astype(np.int64) * 8, start[1:].astype(np.int64) * 8
    out_at = np.cumsum(blocks) - blocks
    out = np.zeros(int(blocks.sum()), np.int32)
    last = np.zeros(len(blocks), np.int64)

    def bits(place: np.ndarray) -> np.ndarray:
        """The next 16 (of at least 25) bits."""
        return (window[np.minimum(place >> 3, len(data))] >> (np.uint64(16) - (place & 7).astype(np.uint64))).astype(np.int64) & 0xFFFF

    def symbol(table: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = table[bits(place)]
        if not found.all():
            raise ValueError("no such Huffman word")
        return found >> 5, place + (found & 31)

    order = np.argsort(-blocks, kind="stable")  # runs that have a block at a step stand first
    left = -blocks[order]
    for step in range(int(blocks.max(initial=0))):
        live = order[: int(np.searchsorted(left, -step, side="left"))]
        s, place = symbol(dc, at[live])
        extra = bits(place) >> (16 - s)
        last[live] += np.where(s == 0, 0, np.where(extra >> np.maximum(s - 1, 0) == 1, extra, extra - (1 << s) + 1))
        place = place + s
        out[out_at[live] + step] = last[live]
        # AC coefficients: passed over up to the end of the block
        going, seen = np.arange(len(live)), np.ones(len(live), np.int64)
        while len(going):
            r, to = symbol(ac, place[going])
            place[going] = to + (r & 15)
            going = going[r != 0]
            seen[going] += (r[r != 0] >> 4) + 1
            if (seen[going] > 64).any():
                raise ValueError("a coefficient stands beyond the block")
            going = going[seen[going] < 64]
        at[live] = place
        if (place > stop[live]).any():
            raise ValueError("the scan ends early")
    return out


def thumbnails(images: list[Image]) -> list[np.ndarray]:
    """Those of images of side_by_side(): all runs with the same tables are decoded at once."""
    out: list = [None] * len(images)
    alike: dict[tuple, list[int]] = {}
    for i, x in enumerate(images):
        t = x.chosen[x.parts[0][0]]
        alike.setdefault((x.tables[t >> 4], x.tables[16 | (t & 15)]), []).append(i)
    for (dc, ac), own in alike.items():
        data, start, blocks, base = [], [], [], 0
        for i in own:
            x = images[i]
            b, s = unstuffed(x.scan)
            columns, rows = x.size()
            n = np.full(-(-columns * rows // x.restart), x.restart)
            n[-1] -= int(n.sum()) - columns * rows
            if len(n) != len(s) - 1:
                raise ValueError("a run is missing")
            data.append(b)
            start.append(s[:-1] + base)
            blocks.append(n)
            base += len(b)
        values = decoded_runs(np.concatenate(data), np.append(np.concatenate(start), base), np.concatenate(blocks), look_up(*dc), look_up(*ac))
        at = 0
        for i, n in zip(own, blocks, strict=True):
            out[i] = images[i].pixels(values[at : at + int(n.sum())])
            at += int(n.sum())
    return out


def parsed(data: bytes) -> list[Image]:
    out, at = [], 0
    while at < len(data):
        out.append(Image(data, at))
        at = out[-1].end
    return out


def read_images(media: list[bytes]) -> list[list[np.ndarray]]:
    """Thumbnails of the images in each stored text."""
    images = [parsed(m) for m in media]
    flat = [x for own in images for x in own]
    fast = iter(thumbnails([x for x in flat if x.side_by_side()]))
    return [[next(fast) if x.side_by_side() else x.thumbnail() for x in own] for own in images]


def read_media(data: bytes) -> list[np.ndarray]:
    return read_images([data])[0]


def thumbnail_hash(t: np.ndarray) -> str:
    """64-bit difference hash: means of an 8 x 9 grid, one bit where the right neighbour is brighter."""
    rows = np.add.reduceat(t.astype(np.int64), np.arange(8) * t.shape[0] // 8, axis=0) if t.shape[0] >= 8 else np.repeat(t.astype(np.int64), -(-8 // t.shape[0]), axis=0)[:8]
    edges = np.arange(10) * t.shape[1] // 9
    cells = np.add.reduceat(rows, edges[:9], axis=1) if t.shape[1] >= 9 else np.repeat(rows, -(-9 // t.shape[1]), axis=1)[:, :9]
    wide = np.diff(edges) if t.shape[1] >= 9 else np.ones(9, np.int64)
    bits = cells[:, 1:] * wide[:-1] > cells[:, :-1] * wide[1:]
    return np.packbits(bits).tobytes().hex()


FEATURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int"


def features(media: bytes, own: list[np.ndarray]) -> tuple:
    """The digest columns of stored bytes and the thumbnails that were read from them."""
    payload = b"".join(t.tobytes() for t in own)
    first = own[0]
    said = ":".join([str(len(own)), *(f"{t.shape[1] * 8}x{t.shape[0] * 8}:{thumbnail_hash(t)}" for t in own)])
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), said, first.shape[1] * 8, first.shape[0] * 8


def batches_of(texts: list[bytes], most: int = 2_000_000) -> list[list[bytes]]:
    """Texts in stretches of about ``most`` bytes; a longer text is one of its own."""
    out: list[list[bytes]] = []
    size = 0
    for t in texts:
        if not out or size + len(t) > most:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t) + UNIT
    return out


def stored(texts: list[bytes]) -> list[tuple]:
    """The digest columns of each text: written, read back, described."""
    out = []
    for some in batches_of(texts):
        media = write_images([padded(t) for t in some])
        out += [(len(t), *features(m, own)) for t, m, own in zip(some, media, read_images(media), strict=True)]
    return out


def media_features(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store each text as baseline JPEG, read the stored bytes back, and give their dimensions, digests and thumbnail hash.

    The media bytes stay in the task that made them; with_media() keeps them as a column. Null text is empty and gives the
    192-byte payload of spaces. A null id stays null; repeated rows each give a row; an empty table gives none; other
    columns are not read. A text too large for one image gives several, joined: ``feature`` has the dimensions and the hash of
    each, ``width`` and ``height`` are those of the first.
    """
    kind = df.schema[doc_id].dataType.simpleString()

    def fn(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        rows = stored(texts)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()]
        cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", *(x.split()[0] for x in FEATURES.split(", "))])

    return map_text(df, [doc_id], text, fn, f"doc_id {kind}, {FEATURES}")


def with_media(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and media (binary): the stored form of each text. Nulls and ties as in media_features."""
    kind = df.schema[doc_id].dataType.simpleString()

    def fn(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([m for some in batches_of(texts) for m in write_images([padded(x) for x in some])], pa.binary())], ["doc_id", "media"])

    return map_text(df, [doc_id], text, fn, f"doc_id {kind}, media binary")
