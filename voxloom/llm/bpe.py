"""Byte-level BPE over whole batches: numpy finds the pre-tokens, each distinct one is encoded once.

The pre-token pattern is that of the vocabulary's tokenizer (contractions, letters, digits, other
signs, each with one leading space; white space). It is found on bytes for texts whose characters
lie below U+0530; any other text, and any with the special token's string, goes to the tokenizers
library whole. Either way the ids are the library's.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache
from pathlib import Path

import numpy as np

from . import textkit as K

LETTER, NUMBER, SPACE, OTHER = range(4)
SPECIAL = b"<|endoftext|>"
#: Distinct pre-tokens kept by a worker; the cache is emptied beyond.
CACHE = 1_500_000


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point below U+0530; white space by the Unicode property."""
    out = np.full(0x530, OTHER, np.uint8)
    for c in range(0x530):
        kind = unicodedata.category(chr(c))[0]
        out[c] = {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE
    return out


def pre_tokens(texts: K.Texts) -> np.ndarray:
    """Positions where pre-tokens start; each ends where the next starts. Texts of one- and two-byte characters only."""
    d, n = texts.data, len(texts.data)
    if not n:
        return np.zeros(0, np.int64)
    table = _classes()
    cls = table[np.minimum(d, 0x7F)]
    lead = np.flatnonzero(d >= 0xC0)
    cls[lead] = table[((d[lead] & 0x1F).astype(np.int32) << 6) | (d[lead + 1] & 0x3F)]
    cls[lead + 1] = cls[lead]
    at = np.zeros(n + 1, bool)  # starts of texts, and the end
    at[texts.bounds] = True
    run = at.copy()
    run[1:n] |= cls[1:] != cls[:-1]
    begin = np.flatnonzero(run)
    own = cls[begin[:-1]]
    space = own == SPACE
    start = np.zeros(n, bool)
    start[begin[:-1][space]] = True
    solid = begin[:-1][~space]
    free = at[solid] | (d[solid - 1] != 0x20)
    start[solid[free]] = True
    # the last white-space character before something else stands alone or leads what follows
    follow = begin[1:][space]
    follow = follow[~at[follow]]
    last = follow - 1 - ((d[follow - 1] & 0xC0) == 0x80)
    start[last] = True
    quote = solid[free & (d[solid] == 0x27)]
    quote = quote[quote + 1 < n]
    quote = quote[run[quote + 1] & ~at[quote + 1]]
    quote = quote[cls[quote + 1] == LETTER]
    if len(quote):
        a = d[quote + 1]
        b = np.where(quote + 2 < n, d[np.minimum(quote + 2, n - 1)], 0)
        b[(quote + 2 >= n) | run[np.minimum(quote + 2, n)]] = 0
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ~one & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        for hit, size in ((one, 1), (two, 2)):
            q = quote[hit]
            start[q + 1] = False
            after = q + 1 + size
            after = after[after < n]
            start[after[~run[after]]] = True
    return np.flatnonzero(start)


def _ranks(path: str):
    """The vocabulary as ranked byte strings for tiktoken's merge loop, which takes a word in a tenth of the time.

    Only where the file's merges are in the order of the ids that they make, so that both give the
    same ids; else None.
    """
    import tiktoken

    model = json.loads(Path(path).read_text())["model"]
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocab = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
    vocab.pop(SPECIAL, None)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if [model["vocab"]["".join(p)] for p in pairs] != list(range(256, 256 + len(pairs))) or len(vocab) != 256 + len(pairs):
        return None
    return tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=vocab, special_tokens={})._core_bpe


class Encoder:
    """Token ids of texts, as tokenizers gives them with add_special_tokens=False."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranks = _ranks(path)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.bytes_first, self.bytes = np.zeros(1, np.int64), np.zeros(0, np.uint8)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        if self.ranks is not None:
            ids = [self.ranks.encode_single_piece(w) for w in words]
        else:
            ids = [x.ids for x in self.tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False)]
        rows = np.arange(len(ids)) + len(self.first) - 1
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(x) for x in ids])])
        self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.uint32)])
        self.bytes_first = np.concatenate([self.bytes_first, self.bytes_first[-1] + np.cumsum([len(w) for w in words])])
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(words), np.uint8)])
        where = np.searchsorted(self.keys, keys)
        self.keys, self.rows = np.insert(self.keys, where, keys), np.insert(self.rows, where, rows)

    def encode(self, texts: K.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and first[i]."""
        high = np.concatenate([[0], np.cumsum(texts.data >= 0xD4)])[texts.bounds]
        odd = np.diff(high) > 0
        angle = texts.data == SPECIAL[0]
        for i in np.unique(np.searchsorted(texts.bounds, np.flatnonzero(angle), "right") - 1):
            odd[i] |= SPECIAL in texts.text(i)
        plain = np.flatnonzero(~odd)
        size = np.diff(texts.bounds)[plain]
        part = texts if len(plain) == len(texts) else K.Texts(texts.data[np.repeat(~odd, np.diff(texts.bounds))], np.concatenate([[0], np.cumsum(size)]))
        ids, first, wrong = self._plain(part)
        odd[plain[wrong]] = True
        if not odd.any():
            return ids, first
        own = dict(zip(plain.tolist(), range(len(plain)), strict=True))
        parts = [self._whole(texts.text(i)) if odd[i] else ids[first[own[i]] : first[own[i] + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _plain(self, texts: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, first[i], and the texts in which a pre-token's bytes are not those its hash stands for."""
        start = pre_tokens(texts)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64)
        end = np.append(start[1:], len(texts.data))
        keys, example, inverse = np.unique(K.span_hash(texts.data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > CACHE:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            raw = texts.data.tobytes()
            self._learn(keys[new], [raw[start[i] : end[i]] for i in example[new]])
            at = np.searchsorted(self.keys, keys)
        row = self.rows[at][inverse]
        n = self.first[row + 1] - self.first[row]
        stop = np.cumsum(n)
        ids = self.ids[np.repeat(self.first[row] - (stop - n), n) + np.arange(stop[-1])]
        size = self.bytes_first[row + 1] - self.bytes_first[row]
        bad = np.flatnonzero((size != end - start) | ~K.same(texts.data, start, np.minimum(size, end - start), self.bytes, self.bytes_first[row]))
        wrong = np.unique(np.searchsorted(texts.bounds, start[bad], "right") - 1)
        return ids, np.concatenate([[0], stop])[np.searchsorted(start, texts.bounds)], wrong


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
