"""SentencePiece encoding and decoding: merges for BPE models, batched Viterbi in numpy for unigram models.

No piece crosses from a word into the space before the next, so each distinct word is segmented
once. In a BPE model scores are merge ranks: adjacent pieces are merged, best score first. In a
unigram model they are log-probabilities: words of equal length advance together, the hashes of
their substrings probe the sorted piece keys, and vectorised maxima leave backpointers.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from . import textkit as K

MARK = "▁"
NORMAL, UNKNOWN, USER, UNUSED, BYTE = 1, 2, 4, 5, 6
UNIGRAM, BPE = 1, 2  # model types of a model file
UNKNOWN_PENALTY = 10.0
CACHE = 1_500_000
LARGE = 2 << 20  # bytes that one call encodes
_B, _SCATTER = np.uint64(0xD1B54A32D192ED03), np.uint64(0x9E3779B97F4A7C15)


def _fields(raw: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(kind) or number()
            yield tag >> 3, raw[at : at + n]
            at += n


class Model:
    """Pieces of a model file, with Viterbi segmentation. unk_score: of a character that no piece covers."""

    def __init__(self, path: str):
        self.pieces: list[tuple[str, float, int]] = []
        self.prefix, collapse, charsmap, self.kind = True, True, b"", UNIGRAM
        for f, body in _fields(Path(path).read_bytes()):
            if f == 1:
                own = dict(_fields(body))
                self.pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0], own.get(3, NORMAL)))
            elif f == 2:
                self.kind = dict(_fields(body)).get(3, UNIGRAM)
            elif f == 3:
                own = dict(_fields(body))
                charsmap, self.prefix, collapse = own.get(2, b""), bool(own.get(3, 1)), bool(own.get(4, 1))
        if charsmap or collapse:
            raise ValueError("only models that leave the text as it is are supported")
        used = [(p, s, i) for i, (p, s, k) in enumerate(self.pieces) if k in (NORMAL, USER)]
        if any(MARK in p.lstrip(MARK) for p, _, _ in used):
            raise ValueError("a piece crosses into a space")
        self.unk = min(s for _, s, _ in used) - UNKNOWN_PENALTY
        self.unk_id = next(i for i, (_, _, k) in enumerate(self.pieces) if k == UNKNOWN)
        self.byte_ids = np.full(256, self.unk_id, np.int64)
        for i, (p, _, k) in enumerate(self.pieces):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.longest = max(len(p) for p, _, _ in used)
        keys = np.array([self._key(p) for p, _, _ in used], np.uint64)
        order = np.argsort(keys)
        self.keys, self.score, self.id = keys[order], np.array([s for _, s, _ in used])[order], np.array([i for _, _, i in used])[order]
        self.maybe = np.zeros(1 << 20, bool)  # top bits of the keys: most substrings are no piece and stop here
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        shown = [p.replace(MARK, " ").encode() if k != BYTE else bytes([int(p[3:5], 16)]) if p else b"" for p, _, k in self.pieces]
        shown = [b"" if k not in (NORMAL, USER, BYTE) else x for x, (_, _, k) in zip(shown, self.pieces, strict=True)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_first = np.concatenate([[0], np.cumsum([len(x) for x in shown])])
        self._clear()

    def _clear(self) -> None:
        self.known, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.bytes_first, self.bytes = np.zeros(1, np.int64), np.zeros(0, np.uint8)

    @staticmethod
    def _key(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * _B + np.uint64(ord(c) + 1)
        return (h * _SCATTER)[0]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words (spaces as MARK) end to end, and first[i]. Of equal scores the longer last piece wins."""
        size = np.array([len(w) for w in words], np.int64)
        parts = [(np.flatnonzero(size == n), int(n)) for n in np.unique(size) if n]
        parts = [(p, n) for own, n in parts for p in np.array_split(own, -(-len(own) * n // (1 << 19)))]
        got = [self._same_length([words[i] for i in own], n) for own, n in parts]
        count = np.zeros(len(words), np.int64)
        for (own, _), (_, c) in zip(parts, got, strict=True):
            count[own] = c
        first = np.concatenate([[0], np.cumsum(count)])
        ids = np.zeros(first[-1], np.int64)
        for (own, _), (x, c) in zip(parts, got, strict=True):
            ids[np.repeat(first[own] - (np.cumsum(c) - c), c) + np.arange(len(x))] = x
        return ids, first

    def _same_length(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n).astype(np.uint64) + np.uint64(1)
        prefix = np.zeros((len(words), n + 1), np.uint64)
        power = K.powers(n + 1, _B)
        for j in range(n):
            prefix[:, j + 1] = prefix[:, j] * _B + code[:, j]
        best = np.full((len(words), n + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((len(words), n + 1), np.int32), np.zeros((len(words), n + 1), np.int32)
        for j in range(1, n + 1):
            low = max(0, j - self.longest)
            key = (prefix[:, j, None] - prefix[:, low:j] * power[j - low : 0 : -1]) * _SCATTER
            score, found = np.full(key.shape, -np.inf), np.full(key.shape, -1, np.int32)
            score[:, -1] = self.unk
            w, k = np.nonzero(self.maybe[(key >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, key[w, k]), len(self.keys) - 1)
            hit = self.keys[at] == key[w, k]
            w, k, at = w[hit], k[hit], at[hit]
            score[w, k], found[w, k] = self.score[at], self.id[at]
            score += best[:, low:j]
            top = score.argmax(1)  # the first of equals: the longest last piece
            best[:, j], back[:, j], piece[:, j] = score[rows, top], low + top, found[rows, top]
        steps, at = [], np.full(len(words), n)
        while (live := np.flatnonzero(at)).size:
            steps.append((live, piece[live, at[live]], back[live, at[live]], at[live]))
            at[live] = back[live, at[live]]
        word, got = np.concatenate([s[0] for s in steps])[::-1], np.concatenate([s[1] for s in steps])[::-1].astype(np.int64)
        order = np.argsort(word, kind="stable")  # steps run from the end, and are reversed here
        word, got = word[order], got[order]
        unknown = np.flatnonzero(got < 0)
        if not len(unknown):
            return got, np.bincount(word, minlength=len(words))
        start = np.concatenate([s[2] for s in steps])[::-1][order]
        runs = {int(u): [int(self.byte_ids[x]) for x in words[word[u]][start[u]].encode("utf-8", "replace")] for u in unknown}
        n_ids = np.ones(len(got), np.int64)
        n_ids[unknown] = [len(r) for r in runs.values()]
        out = np.repeat(got, n_ids)
        for u, to in zip(unknown, (np.cumsum(n_ids) - n_ids)[unknown], strict=True):
            out[to : to + n_ids[u]] = runs[int(u)]
        return out, np.bincount(word, n_ids, minlength=len(words)).astype(np.int64)

    def encode(self, texts: K.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and first[i]. An empty text has none."""
        d = texts.data
        if not len(d):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        begin = np.zeros(len(d) + 1, bool)
        space = d == 0x20
        begin[:-1] = space
        begin[1:-1] &= ~space[:-1]
        mark = np.flatnonzero((d[:-2] == 0xE2) & (d[1:-1] == 0x96) & (d[2:] == 0x81)) if len(d) > 2 else []
        for t in np.unique(np.searchsorted(texts.bounds, mark, "right") - 1):  # the mark itself in a text: one word
            begin[texts.bounds[t] : texts.bounds[t + 1]] = False
        heads = texts.bounds[:-1][np.diff(texts.bounds) > 0]
        begin[heads] = True
        start = np.flatnonzero(begin[:-1])
        end = np.append(start[1:], len(d))
        lead = np.zeros(len(d), bool)
        lead[heads] = self.prefix
        lead = lead[start]
        hashes = K.mix(K.span_hash(d, start, end) + lead.astype(np.uint64))
        keys, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > CACHE:
            self._clear()
        at = np.minimum(np.searchsorted(self.known, keys), max(0, len(self.known) - 1))
        new = self.known[at] != keys if len(self.known) else np.ones(len(keys), bool)
        if new.any():
            raw = d.tobytes()
            words = [(MARK if lead[i] else "") + raw[start[i] : end[i]].decode("utf-8", "replace").replace(" ", MARK) for i in example[new]]
            found, bounds = self.segment(words)
            rows = np.arange(len(words)) + len(self.first) - 1
            self.first = np.concatenate([self.first, self.first[-1] + bounds[1:]])
            self.ids = np.concatenate([self.ids, found])
            plain = [raw[start[i] : end[i]] for i in example[new]]
            self.bytes_first = np.concatenate([self.bytes_first, self.bytes_first[-1] + np.cumsum([len(w) for w in plain])])
            self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(plain), np.uint8)])
            where = np.searchsorted(self.known, keys[new])
            self.known, self.rows = np.insert(self.known, where, keys[new]), np.insert(self.rows, where, rows)
            at = np.searchsorted(self.known, keys)
        row = self.rows[at][inverse]
        size = self.bytes_first[row + 1] - self.bytes_first[row]
        bad = np.flatnonzero((size != end - start) | ~K.same(d, start, np.minimum(size, end - start), self.bytes, self.bytes_first[row]))
        values, first = self.ids, self.first
        if len(bad):  # another word has the same hash: segmented without the cache
            raw = d.tobytes()
            found, bounds = self.segment([(MARK if lead[i] else "") + raw[start[i] : end[i]].decode("utf-8", "replace").replace(" ", MARK) for i in bad])
            row[bad] = len(first) - 1 + np.arange(len(bad))
            values, first = np.concatenate([values, found]), np.concatenate([first, first[-1] + bounds[1:]])
        return _gather(values, first, row), np.concatenate([[0], np.cumsum(first[row + 1] - first[row])])[np.searchsorted(start, texts.bounds)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> K.Texts:
        """The texts of ids; the space that encoding puts in front is taken off."""
        data = _gather(self.shown, self.shown_first, ids)
        bounds = np.concatenate([[0], np.cumsum(self.shown_first[ids + 1] - self.shown_first[ids])])[first]
        if self.prefix and len(data):
            heads = bounds[:-1][np.diff(bounds) > 0]
            keep = np.ones(len(data), bool)
            keep[heads] = data[heads] != 0x20
            bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
            data = data[keep]
        return K.Texts(data, bounds)


class Merges(Model):
    """Pieces of a BPE model file, with segmentation by merges."""

    def __init__(self, path: str):
        super().__init__(path)
        if any(k in (USER, UNUSED) for _, _, k in self.pieces):
            raise ValueError("BPE models with user-defined or unused pieces are not supported")
        self.rank = {p: s for p, s, k in self.pieces if k == NORMAL}
        self.id_of = {p: i for i, (p, _, k) in enumerate(self.pieces) if k == NORMAL}

    def merge(self, word: str) -> list[str]:
        """The characters after all merges of adjacent pieces into a piece: best score first, of equal scores the leftmost."""
        part: list[str | None] = list(word)
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list[tuple[float, int, str]] = []

        def meet(i: int, j: int) -> None:
            if i >= 0 and j < len(part) and (s := self.rank.get(both := part[i] + part[j])) is not None:
                heapq.heappush(heap, (-s, i, both))

        for i in range(len(part) - 1):
            meet(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            if part[i] is None or (j := after[i]) >= len(part) or part[i] + part[j] != both:
                continue  # one of the two has gone into another piece
            part[i], part[j], after[i] = both, None, after[j]
            if after[i] < len(part):
                before[after[i]] = i
            meet(before[i], i)
            meet(i, after[i])
        return [p for p in part if p is not None]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words (spaces as MARK) end to end, and first[i]. What is no piece is given as bytes."""
        got: list[int] = []
        first = [0]
        for word in words:
            for p in self.merge(word):
                i = self.id_of.get(p)
                if i is None:
                    got += [int(self.byte_ids[x]) for x in p.encode("utf-8", "replace")]
                else:
                    got.append(i)
            first.append(len(got))
        return np.array(got, np.int64), np.array(first, np.int64)


def _gather(values: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    n = first[rows + 1] - first[rows]
    stop = np.cumsum(n)
    return values[np.repeat(first[rows] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """Viterbi over a file's pieces, whatever its type; see encoder."""
    return Model(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Model:
    """The segmentation that the file's model type names."""
    tool = Model(path)
    if tool.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return Merges(path) if tool.kind == BPE else tool


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit), round_trip (whether decoding gives the text back), and ids with keep_ids.

    A null text counts as empty and has no ids. A text with the mark U+2581 decodes to spaces there.
    Repeated rows and null ids are encoded each.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path or bpe.default_path("piece_bpe_32k.model"))
        for batch in batches:
            for part, texts in K.Texts.of(batch.column(1)).chunks(LARGE):
                ids, first = tool.encode(texts)
                back = tool.decode(ids, first)
                own = ids.astype("<u4")
                crc = [zlib.crc32(own[a:b].tobytes()) for a, b in zip(first[:-1], first[1:], strict=True)]
                same = [back.text(i) == texts.text(i) for i in range(len(texts))]
                columns = [batch.column(0).slice(part.start, len(texts)), pa.array(np.diff(first), pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_crc32", "round_trip", "ids"][: len(columns)])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * keep_ids)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of encoded ids; null ids give an empty text, ids outside the vocabulary an error."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path or bpe.default_path("piece_bpe_32k.model"))
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            first = np.concatenate([[0], np.cumsum([len(x or ()) for x in lists])]).astype(np.int64)
            ids = np.array([i for x in lists for i in x or ()], np.int64)
            if len(ids) and not (0 <= ids.min() and ids.max() < len(tool.pieces)):
                raise ValueError("an id is not in the vocabulary")
            texts = tool.decode(ids, first)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([texts.text(i).decode("utf-8", "replace") for i in range(len(texts))], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_ids=False)
