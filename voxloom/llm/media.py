"""Media columns: baseline JPEG written and read in numpy.

The reader parses markers, Huffman-decodes baseline scans (any sampling, any tables, with or without
restart intervals) and reconstructs the DC-only luminance thumbnail: one sample for each 8 by 8
block. All restart intervals of a batch of images are decoded in lockstep, one block of each a step.

The writer stores bytes as such a thumbnail: every byte is the value of one flat block, so it comes
back exactly from the DC terms.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as K

UNIT = 576  # payloads are padded to a multiple of it; also the blocks in a row of a stored image
INTERVAL = 72  # blocks between restart markers
LARGE = 2 << 20  # bytes that one call takes
MOST_ROWS = 8191  # rows of blocks in one image; a longer payload is several images end to end

# The code lengths of the standard luminance DC table (ITU-T T.81, table K.3).
DC_COUNTS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_VALUES = tuple(range(12))
AC_COUNTS = (1,) + (0,) * 15  # the one code '0': end of block
AC_VALUES = (0,)


class BadImage(ValueError):
    """Not a baseline JPEG."""


def codes(counts: tuple[int, ...], values: tuple[int, ...]) -> dict[int, tuple[int, int]]:
    """Canonical Huffman codes: value to (code, length)."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[values[at]] = (code, length)
            code, at = code + 1, at + 1
        code <<= 1
    return out


@lru_cache(maxsize=32)
def lookup(counts: tuple[int, ...], values: tuple[int, ...]) -> np.ndarray:
    """256 times the value, plus the code's length, for each 16-bit window; length 0 marks no code."""
    out = np.zeros(1 << 16, np.int64)
    for v, (code, n) in codes(counts, values).items():
        out[code << (16 - n) : (code + 1) << (16 - n)] = v << 8 | n
    return out


def _marker(kind: int, body: bytes) -> bytes:
    return bytes([0xFF, kind]) + struct.pack(">H", len(body) + 2) + body


def _block_codes() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for a flat block, by its DC difference + 255: category, value, end of block."""
    code, out = codes(DC_COUNTS, DC_VALUES), []
    for diff in range(-255, 256):
        size = abs(diff).bit_length()
        bits, length = code[size]
        out.append((((bits << size) | (diff if diff >= 0 else diff + (1 << size) - 1)) << 1, length + size + 1))
    return tuple(np.array(x, np.uint64) for x in zip(*out, strict=True))


_BITS, _BIT_LENGTH = _block_codes()


def _head(rows: int) -> bytes:
    head = b"\xff\xd8" + _marker(0xDB, b"\0" + bytes([8] * 64)) + _marker(0xC0, struct.pack(">BHHB", 8, rows * 8, UNIT * 8, 1) + b"\x01\x11\x00")
    head += _marker(0xC4, b"\x00" + bytes(DC_COUNTS) + bytes(DC_VALUES)) + _marker(0xC4, b"\x10" + bytes(AC_COUNTS) + bytes(AC_VALUES))
    return head + _marker(0xDD, struct.pack(">H", INTERVAL)) + _marker(0xDA, b"\x01\x01\x00\x00\x3f\x00")


def _intervals(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded restart intervals, each after its marker, and where each starts (its marker is two bytes before)."""
    level = samples.reshape(-1, INTERVAL).astype(np.int16)
    diff = np.empty_like(level)
    diff[:, 1:] = level[:, 1:] - level[:, :-1] + 255
    diff[:, 0] = level[:, 0] + (255 - 128)
    each, sizes = _BITS[diff].reshape(len(level), -1, 4), _BIT_LENGTH[diff].reshape(len(level), -1, 4)
    bits, length = each[:, :, 0], sizes[:, :, 0]
    for k in range(1, 4):  # four blocks make a word of at most 60 bits
        bits = (bits << sizes[:, :, k]) | each[:, :, k]
        length = length + sizes[:, :, k]
    length = length.astype(np.int64)
    used = length.sum(1)
    pad = -used % 8
    ends = np.cumsum((used + pad) >> 3)
    start = (np.cumsum(length, axis=1) - length + 8 * (ends - ((used + pad) >> 3))[:, None]).ravel()
    bits = (bits.ravel() << (64 - length.ravel()).astype(np.uint64))
    low, at = (start & 63).astype(np.uint64), start >> 6
    size = int(ends[-1])
    packed = np.zeros(size // 8 + 2, np.uint64)
    np.add.at(packed, at, bits >> low)
    np.add.at(packed, at + 1, (bits << np.uint64(1)) << (np.uint64(63) - low))
    packed = packed.byteswap().view(np.uint8)[:size]
    packed[ends - 1] |= ((1 << pad) - 1).astype(np.uint8)
    full = packed == 0xFF
    size = np.diff(ends, prepend=0)
    place = np.arange(len(packed)) + (np.cumsum(full) - full) + np.repeat(2 * np.arange(1, len(ends) + 1), size)
    out = np.zeros(len(packed) + int(full.sum()) + 2 * len(ends), np.uint8)
    out[place] = packed
    begin = place[ends - size]
    out[begin - 2] = 0xFF
    out[begin - 1] = 0xD0 + np.arange(-1, len(begin) - 1) % 8
    return out, np.append(begin, len(out) + 2)


def encode_all(samples: np.ndarray, units: np.ndarray) -> list[bytes]:
    """For each payload (units[i] units of samples, end to end): one or more JPEGs end to end."""
    per = UNIT // INTERVAL
    out, begin = _intervals(samples)
    raw, result, unit = out.tobytes(), [], 0
    for n in units.tolist():
        parts = []
        for k in range(0, n, MOST_ROWS):
            rows = min(MOST_ROWS, n - k)
            parts.append(_head(rows) + raw[begin[unit * per] : begin[(unit + rows) * per] - 2] + b"\xff\xd9")
            unit += rows
        result.append(b"".join(parts))
    return result


def encode(payload: bytes) -> bytes:
    """One or more baseline JPEGs whose luminance thumbnails are the payload (a positive multiple of UNIT bytes)."""
    return encode_all(np.frombuffer(payload, np.uint8), np.array([len(payload) // UNIT]))[0]


@dataclass
class Image:
    width: int = 0
    height: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantisation table
    quantisers: dict[int, int] = field(default_factory=dict)  # DC step of each table
    tables: dict[int, tuple[tuple[int, ...], tuple[int, ...]]] = field(default_factory=dict)
    interval: int = 0
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # component id, DC table, AC table
    data: np.ndarray | None = None  # entropy-coded bytes without stuffing
    starts: np.ndarray | None = None  # of the restart intervals

    def luminance(self) -> tuple[int, int]:
        return self.components[0][1:3]

    def blocks(self) -> list[tuple[int, int, int, bool]]:
        """Component position, DC and AC table of each block of an MCU, and whether it is luminance."""
        sampling = {c[0]: c[1] * c[2] for c in self.components}
        alone = len(self.scan) == 1
        return [(k, dc, ac, cid == self.components[0][0]) for k, (cid, dc, ac) in enumerate(self.scan) for _ in range(1 if alone else sampling[cid])]

    def grid(self) -> tuple[int, int, int]:
        """MCUs down, MCUs across; luminance blocks across."""
        h, v = (1, 1) if len(self.scan) == 1 else (max(c[1] for c in self.components), max(c[2] for c in self.components))
        down, over = -(-self.height // (8 * v)), -(-self.width // (8 * h))
        return down, over, over * (1 if len(self.scan) == 1 else self.luminance()[0])


def parse(raw: bytes) -> list[Image]:
    """The images that lie end to end in raw, each with one scan that holds luminance."""
    out, at = [], 0
    while at < len(raw):
        if raw[at : at + 2] != b"\xff\xd8":
            raise BadImage("no start of image")
        image, at = Image(), at + 2
        while True:
            if at + 4 > len(raw) or raw[at] != 0xFF:
                if raw[at : at + 2] == b"\xff\xd9":
                    raise BadImage("no scan")
                raise BadImage("no marker")
            kind = raw[at + 1]
            if kind == 0xFF:
                at += 1
                continue
            (n,) = struct.unpack(">H", raw[at + 2 : at + 4])
            body, at = raw[at + 4 : at + 2 + n], at + 2 + n
            if kind == 0xDB:
                while body:
                    wide, t = body[0] >> 4, body[0] & 15
                    image.quantisers[t] = struct.unpack(">H", body[1:3])[0] if wide else body[1]
                    body = body[1 + 64 * (1 + wide) :]
            elif kind == 0xC0:
                depth, image.height, image.width, m = struct.unpack(">BHHB", body[:6])
                if depth != 8:
                    raise BadImage("not 8 bits deep")
                image.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(m)]
            elif kind in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                raise BadImage("not baseline")
            elif kind == 0xC4:
                while body:
                    counts = tuple(body[1:17])
                    image.tables[body[0]] = (counts, tuple(body[17 : 17 + sum(counts)]))
                    body = body[17 + sum(counts) :]
            elif kind == 0xDD:
                (image.interval,) = struct.unpack(">H", body[:2])
            elif kind == 0xDA:
                image.scan = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
                break
        d = np.frombuffer(raw, np.uint8, offset=at)
        ff = np.flatnonzero(d[:-1] == 0xFF)
        after = d[ff + 1]
        ends = ff[(after != 0) & ((after & 0xF8) != 0xD0)]
        if not len(ends) or not image.components or image.scan[0][0] != image.components[0][0]:
            raise BadImage("no end of scan, or no frame before it")
        d, ff, after = d[: ends[0]], ff[ff < ends[0]], after[ff < ends[0]]
        keep = np.ones(len(d) + 1, bool)
        keep[ff + 1] = False
        restart = ff[after != 0]
        keep[restart] = False
        image.data = d[keep[:-1]]
        image.starts = np.concatenate([[0], np.cumsum(keep)[restart]])
        out.append(image)
        at += int(ends[0])
        end = raw.find(b"\xff\xd9", at)
        if end < 0:
            raise BadImage("no end of image")
        at = end + 2
    return out


def _ahead(words: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """The bits from a position on, 57 at least, at the top of a 64-bit word."""
    return words[bit >> 3] << (bit & 7).astype(np.uint64)


def _decode(images: list[Image]) -> list[np.ndarray]:
    """Luminance DC levels in scan order of images that share tables and MCU layout."""
    plan = images[0].blocks()
    tables = {t: lookup(*v) for t, v in images[0].tables.items()}
    data = [x for i in images for x in (i.data, np.full(8, 255, np.uint8))]
    shift = np.cumsum([0, *(len(i.data) + 8 for i in images[:-1])])
    b = np.concatenate([*data, np.zeros(16, np.uint8)])
    words = np.zeros(len(b) - 7, np.uint64)
    for k in range(8):
        words |= b[k : len(b) - 7 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    bit = np.concatenate([(i.starts + s) * 8 for i, s in zip(images, shift, strict=True)])
    mcus = []
    for i in images:
        down, over, _ = i.grid()
        step = i.interval or down * over
        left = down * over - step * np.arange(len(i.starts))
        if left[-1] <= 0 or left[-1] > step:
            raise BadImage("restart intervals don't fill the image")
        mcus.append(np.minimum(step, left))
    per, mcus = [len(m) for m in mcus], np.concatenate(mcus)
    light = sum(p[3] for p in plan)
    levels = np.zeros((len(bit), int(mcus.max()) * light), np.int64)
    pred = np.zeros((len(bit), 1 + max(p[0] for p in plan)), np.int64)
    limit = 8 * (len(words) - 1)
    whole = mcus.min() == mcus.max()
    for m in range(int(mcus.max())):
        live = slice(None) if whole else np.flatnonzero(mcus > m)
        pos, column = bit[live], m * light
        for k, dc, ac, lum in plan:
            top = np.uint64(48)
            ahead = _ahead(words, pos)
            found = tables[dc][(ahead >> top).astype(np.int64)]
            length, size = found & 255, found >> 8
            bad = not length.all()
            ahead <<= length.astype(np.uint64)
            extra = ((ahead >> np.uint64(1)) >> (63 - size).astype(np.uint64)).astype(np.int64)
            ahead <<= size.astype(np.uint64)
            pred[live, k] += extra - np.where(extra < (1 << size >> 1), (1 << size) - 1, 0)
            if lum:
                levels[live, column] = pred[live, k]
                column += 1
            found = tables[16 + ac][(ahead >> top).astype(np.int64)]
            symbol = found >> 8
            bad |= not (found & 255).all()
            pos = pos + length + size + (found & 255) + (symbol & 15)
            busy = np.flatnonzero(symbol)
            at = np.where(symbol[busy] == 0xF0, 17, (symbol[busy] >> 4) + 2)
            while len(busy):
                go = at < 64
                busy, at = busy[go], at[go]
                found = tables[16 + ac][(_ahead(words, np.minimum(pos[busy], limit)) >> top).astype(np.int64)]
                symbol = found >> 8
                bad |= not (found & 255).all()
                pos[busy] += (found & 255) + (symbol & 15)
                more = symbol != 0
                busy, at = busy[more], at[more] + np.where(symbol[more] == 0xF0, 16, (symbol[more] >> 4) + 1)
            if bad:
                raise BadImage("no such code")
        bit[live] = np.minimum(pos, limit)
    out, row = [], 0
    for n in per:
        out.append(np.concatenate([levels[r, : mcus[r] * light] for r in range(row, row + n)]) if not whole else levels[row : row + n].ravel())
        row += n
    return out


def thumbnails(images: list[Image]) -> list[np.ndarray]:
    """The DC-only luminance thumbnail of each image: 8-bit samples, one a block."""
    groups: dict[tuple, list[int]] = defaultdict(list)
    for k, i in enumerate(images):
        groups[(tuple(i.blocks()), tuple(sorted(i.tables.items())))].append(k)
    out: list = [None] * len(images)
    for own in groups.values():
        for k, level in zip(own, _decode([images[k] for k in own]), strict=True):
            i = images[k]
            down, over, wide = i.grid()
            h, v = (1, 1) if len(i.scan) == 1 else i.luminance()
            sample = np.clip(np.floor(level * i.quantisers[i.components[0][3]] / 8 + 0.5) + 128, 0, 255).astype(np.uint8)
            sample = sample.reshape(down, over, v, h).transpose(0, 2, 1, 3).reshape(down * v, wide)
            most_h, most_v = max(c[1] for c in i.components), max(c[2] for c in i.components)
            out[k] = sample[: -(-i.height * i.luminance()[1] // (8 * most_v)), : -(-i.width * i.luminance()[0] // (8 * most_h))]
    return out


def thumbnail_hash(thumb: np.ndarray) -> str:
    """64-bit difference hash: 8 bands of rows by 9 runs of columns, each mean against its right neighbour. Every sample counts."""
    rows, columns = ((np.arange(n + 1) * size) // n for n, size in ((8, thumb.shape[0]), (9, thumb.shape[1])))
    whole = np.zeros((thumb.shape[0] + 1, 10), np.int64)
    run = np.concatenate([np.zeros((thumb.shape[0], 1), np.int64), np.cumsum(thumb, axis=1, dtype=np.int64)], axis=1)
    np.cumsum(run[:, columns], axis=0, out=whole[1:])
    low, high = np.minimum(rows[:-1], thumb.shape[0] - 1), np.maximum(rows[1:], rows[:-1] + 1).clip(max=thumb.shape[0])
    band = whole[high] - whole[low]
    mean = np.diff(band, axis=1) / ((high - low)[:, None] * np.maximum(1, np.diff(columns)))
    return np.packbits(mean[:, 1:] > mean[:, :-1]).tobytes().hex()


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: the text's UTF-8 bytes (null: none), padded with bytes 255 to a positive multiple of UNIT, as JPEG.

    Repeated rows and null ids are stored each; equal texts give equal bytes. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in K.Texts.of(batch.column(1)).chunks(LARGE):
                n = np.diff(texts.bounds)
                units = np.maximum(1, -(-n // UNIT))
                samples = np.full(int(units.sum()) * UNIT, 255, np.uint8)
                to = (np.cumsum(units) - units) * UNIT - texts.bounds[:-1]
                samples[np.arange(len(texts.data)) + np.repeat(to, n)] = texts.data
                media = encode_all(samples, units)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(texts)), pa.array(n, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def describe(stored: DataFrame) -> DataFrame:
    """What the stored bytes hold: payload size, hashes, and the feature (thumbnail dimensions and hash).

    Null media, or media that isn't a baseline JPEG, gives null columns.
    """
    kind = stored.schema["doc_id"].dataType.simpleString()
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = batch.column("media")
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in media]
            i = 0
            while i < len(media):
                j, total = i, 0
                while j < len(media) and (j == i or total + sizes[j] <= LARGE):
                    total, j = total + sizes[j], j + 1
                rows, images, found = [], [], []
                for x in media[i:j]:
                    raw = x.as_py()
                    try:
                        own = parse(raw) if raw else []
                    except (BadImage, IndexError, struct.error):
                        own = []
                    rows.append((raw, len(own)))
                    images += own
                try:
                    found = thumbnails(images)
                except (BadImage, KeyError, IndexError):
                    found = []
                    for im in images:
                        try:
                            found += thumbnails([im])
                        except (BadImage, KeyError, IndexError):
                            found.append(None)
                out, at = [], 0
                for raw, n in rows:
                    own, at = found[at : at + n], at + n
                    if not n or any(t is None for t in own):
                        out.append((None,) * 6)
                        continue
                    payload = b"".join(t.tobytes() for t in own)
                    feature = ";".join(f"{t.shape[1] * 8}x{t.shape[0] * 8}:{thumbnail_hash(t)}" for t in own)
                    out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), batch.column("n_bytes").slice(i, j - i), *(pa.array([r[k] for r in out], t) for k, t in enumerate(types))], ["doc_id", "n_bytes", *names])
                i = j

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(store(spark.read.parquet(f"{sf_dir}/documents.parquet")))


