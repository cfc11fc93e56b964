"""Masked pseudo-likelihood: a bidirectional window network, trained in numpy, predicts every token from both sides.

Words (A-Z lower-cased) of the whole corpus are counted. The HEADS most frequent (of LEAST occurrences) are classes of
their own; every other word, a rare one, belongs to one of SUFFIXES classes by its last three bytes.
The network takes the classes of the WINDOW words on each side through tanh of their summed
embeddings to the class of the word between, as two digits. It starts at the class counts and trains
on all documents in rounds of parameter mixing.

A rare word's probability is that of the rare classes, times its own among the rare words of its
context: of the a times (out of b) that the corpus has it, or any rare word, between the same two
neighbours elsewhere, with the network as prior:

    (a + PRIOR * class given rare * count of the word / count of its class) / (b + PRIOR)

The occurrence itself is left out of a and b. The sum of log-probabilities of all words scores a
document. Words and contexts beyond any table that a task holds meet their counts in the shuffle:
packed by word, then by context; contexts that crowd a flush send combined counts, and their
occurrences join the totals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from . import textkit as K

DIGIT = 64
CLASSES = DIGIT * DIGIT
RARE_DIGITS = 4  # the last first digits, those of the rare classes
HEADS = CLASSES - RARE_DIGITS * DIGIT
LEAST = 50  # occurrences of a head: fewer teach a class of its own too little
KNOWN = 1 << 16  # of the most frequent words at most, whose counts every task holds
WINDOW = 2
HIDDEN = 16
ROUNDS = 1
RATE, BATCH = 0.5, 2048
PRIOR = 2.0  # occurrences that the network's word weighs against a context's
BLOCK = 4096  # weights in one row of what is gathered
FLUSH = 1 << 18  # occurrences in a flush
CROWD = 256  # occurrences of one context in a flush from which they go by combined counts
_HALVES = np.repeat(np.eye(2, dtype=np.float32), DIGIT, axis=0)
DOCUMENT, BY_WORD, BY_CONTEXT, COUNTS, CROWDED, SUM, TOTAL = range(7)
_EDGE = np.uint64(0x2545F4914F6CDD1D)  # stands for the neighbour at an end of a text


@dataclass
class Vocabulary:
    """word, count, own: the KNOWN most frequent words by hash, their counts, and their class (-1: by suffix). total: of each class."""

    word: np.ndarray
    count: np.ndarray
    own: np.ndarray
    total: np.ndarray

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word (0 without), and whether it is known."""
        if not len(self.word):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.word, words), len(self.word) - 1)
        return at, self.word[at] == words


@dataclass
class Network:
    """embed[side][class], bias, out (first digits, then second digits), base, link[first][second]."""

    embed: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: np.ndarray
    link: np.ndarray

    @classmethod
    def fresh(cls, total: np.ndarray | None = None, seed: int = 7) -> Network:
        """Small random weights, and the class counts as the bias."""
        r = np.random.default_rng(seed)
        net = cls(*(r.normal(0, 0.1, s).astype(np.float32) * k for s, k in (((2 * WINDOW * (CLASSES + 1), HIDDEN), 1), ((HIDDEN,), 0), ((HIDDEN, 2 * DIGIT), 3), ((DIGIT,), 0), ((DIGIT, DIGIT), 0))))
        if total is not None and total.sum():
            each = total.reshape(DIGIT, DIGIT) + 0.01
            net.base = np.log(each.sum(1) / each.sum()).astype(np.float32)
            net.link = np.log(each / each.sum(1, keepdims=True)).astype(np.float32)
        return net

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.bias, self.out, self.base, self.link]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        like, out, at = cls.fresh().arrays(), [], 0
        for a in like:
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return cls(*out)

    def forward(self, context: np.ndarray, target: np.ndarray):
        """Hidden layer, first and second digits, logits of both, exponentials, and their sums."""
        hidden = self.embed.take(context[:, 0], axis=0)
        for k in range(1, context.shape[1]):
            hidden += self.embed.take(context[:, k], axis=0)
        hidden += self.bias
        np.tanh(hidden, out=hidden)
        logit = hidden @ self.out
        first, second = target // DIGIT, target & (DIGIT - 1)
        logit[:, :DIGIT] += self.base
        logit[:, DIGIT:] += self.link.take(first, axis=0)
        np.clip(logit, -60, 60, out=logit)
        grown = np.exp(logit)
        return hidden, first, second, logit, grown, grown @ _HALVES

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each class in its context."""
        return self.log_probabilities(context, target)[0]

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each class in its context, and of all rare classes together."""
        _, first, second, logit, grown, total = self.forward(context, target)
        row = np.arange(len(target))
        rare = grown[:, DIGIT - RARE_DIGITS : DIGIT].sum(1) / total[:, 0]
        return logit[row, first] + logit[row, DIGIT + second] - np.log(total).sum(1), np.log(rare)

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step on a mini-batch; embeddings take gradients of their own words only."""
        hidden, first, second, _, grad, total = self.forward(context, target)
        row, n = np.arange(len(target)), len(target)
        grad /= total.repeat(DIGIT, axis=1)
        grad[row, first] -= 1
        grad[row, DIGIT + second] -= 1
        back = grad @ self.out.T
        back *= 1 - hidden * hidden
        self.out -= np.float32(rate / n * 8) * (hidden.T @ grad)
        self.base -= np.float32(rate / n) * grad[:, :DIGIT].sum(0)
        self.bias -= np.float32(rate / n) * back.sum(0)
        back *= np.float32(-rate * 0.1)
        for k in range(context.shape[1]):
            own = context[:, k].astype(np.uint16)
            order = np.argsort(own, kind="stable")
            own = own[order]
            at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            move = np.add.reduceat(back.take(order, axis=0), at, axis=0)
            move /= np.sqrt(np.diff(np.append(at, n)), dtype=np.float32)[:, None]
            self.embed[own[at]] += move


def suffixes(texts: K.Texts, w: K.Spans) -> np.ndarray:
    """Rare class of every word, by its last three bytes."""
    d, out = K._LOWER[texts.data], np.zeros(len(w.start), np.uint64)
    for k in range(1, 4):
        has = w.end - w.start >= k
        out[has] += d[w.end[has] - k].astype(np.uint64) << np.uint64(8 * k)
    return HEADS + (K.mix(out) % np.uint64(CLASSES - HEADS)).astype(np.int32)


def examples(texts: K.Texts, names: Vocabulary) -> tuple[np.ndarray, np.ndarray, K.Spans, np.ndarray, np.ndarray]:
    """Context rows (embedding row numbers, sides in order), class of every word, the words, their places in names and whether they have one."""
    w = K.words(texts, lower=True)
    at, known = names.look_up(w.hash)
    target = suffixes(texts, w)
    if known.any():
        head = known & (names.own[at] >= 0)
        target[head] = names.own[at[head]]
    owner, n = w.owner(), len(target)
    context = np.full((n, 2 * WINDOW), CLASSES, np.int32)
    for k, d in enumerate([d for d in range(-WINDOW, WINDOW + 1) if d]):
        to = np.arange(max(0, -d), max(0, min(n, n - d)))
        same = to[owner[to] == owner[to + d]]
        context[same, k] = target[same + d]
        context[:, k] += k * (CLASSES + 1)
    return context, target, w, at, known


def count_words(docs: DataFrame, text_col: str = "text", known: int = KNOWN, heads: int = HEADS, least: int = LEAST) -> Vocabulary:
    """Counts of all words of all documents; the driver sees the most frequent, known of them at most (heads of which are classes), and the class totals."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged():
            word, suffix, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            own, first, inverse = np.unique(word, return_index=True, return_inverse=True)
            return own, suffix[first], np.bincount(inverse, n).astype(np.int64)

        def out() -> pa.RecordBatch:
            word, suffix, n = merged()
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(suffix), pa.array(n)], ["word", "suffix", "n"])

        for batch in batches:
            for _, texts in K.Texts.of(batch.column(0)).chunks():
                w = K.words(texts, lower=True)
                parts.append((w.hash, suffixes(texts, w), np.ones(len(w.hash), np.int64)))
                if sum(len(p[0]) for p in parts) > FLUSH:
                    parts[:] = [merged()]
                    if len(parts[0][0]) > FLUSH // 2:
                        yield out()
        if parts:
            yield out()

    words = rows.mapInArrow(count, "word long, suffix int, n long").groupBy("word").agg(F.min("suffix").alias("suffix"), F.sum("n").alias("n"))
    words = storage.written(words, "words")
    band = F.floor(F.log2("n") * 64).cast("int")  # at most some thousand bands of counts; whole bands are known, as many as fit
    sizes = sorted(((r["band"], r["count"]) for r in words.groupBy(band.alias("band")).count().collect()), reverse=True)
    total, least_band = 0, 1 << 30
    for b, n in sizes:
        if (total := total + n) > known:
            break
        least_band = b
    top = words.where(band >= least_band).toPandas().sort_values(["n", "word"], ascending=[False, True])
    by = {r["suffix"]: r["n"] for r in words.groupBy("suffix").agg(F.sum("n").alias("n")).collect()}
    total = np.zeros(CLASSES)
    total[list(by)] = list(by.values())
    word, n, suffix = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), top["suffix"].to_numpy(np.int64)
    heads = min(heads, int((n >= least).sum()))
    own = np.where(np.arange(len(word)) < heads, np.arange(len(word)), -1)
    np.subtract.at(total, suffix[:heads], n[:heads])
    total[: len(n[:heads])] = n[:heads]
    order = np.argsort(word)
    return Vocabulary(word[order], n[order], own[order], total)


def train(docs: DataFrame, names: Vocabulary, text_col: str = "text", rounds: int = ROUNDS) -> Network:
    """The mixed network over all documents; the class counts alone if there are no words.

    In each round every partition trains a copy on its documents, and the copies are averaged by
    tokens. The result depends on how the rows lie in partitions, by a few hundredths of a nat a word.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    net = Network.fresh(names.total)
    salts = max(1, storage.scan_partitions(docs) // 32)
    schema = "block int, salt int, weight double, value binary"

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weighted means by block of what a partition has; a few numbers a block at any time."""
        total: dict[int, np.ndarray] = {}
        weight: dict[int, float] = {}
        for batch in batches:
            for b, w, v in zip(batch.column("block").to_pylist(), batch.column("weight").to_pylist(), batch.column("value"), strict=True):
                x = np.frombuffer(v.as_buffer(), "<f4").astype(np.float64) * w
                total[b] = total[b] + x if b in total else x
                weight[b] = weight.get(b, 0.0) + w
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([0] * len(total), pa.int32()), pa.array(list(weight.values())), pa.array([(total[b] / weight[b]).astype("<f4").tobytes() for b in total], pa.binary())], ["block", "salt", "weight", "value"])

    for turn in range(rounds):
        start = net.flat()

        def fit(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            own, seen = Network.of(start), 0
            for batch in batches:
                for _, texts in K.Texts.of(batch.column(0)).chunks():
                    context, target, *_ = examples(texts, names)
                    for i in range(0, len(target), BATCH):
                        own.step(context[i : i + BATCH], target[i : i + BATCH], RATE / (1 + turn) / (1 + seen / 3e6) ** 0.5)
                    seen += len(target)
            if seen:
                flat = own.flat().astype("<f4")
                parts = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
                salt = (TaskContext.get().partitionId() if TaskContext.get() else 0) % salts
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([salt] * len(parts), pa.int32()), pa.array([float(seen)] * len(parts)), pa.array(parts, pa.binary())], ["block", "salt", "weight", "value"])

        blocks = -(-len(start) // BLOCK)
        some = rows.mapInArrow(fit, schema).repartition(blocks * salts, "block", "salt").mapInArrow(mix, schema)
        whole = storage.written(some.repartition(blocks, "block").mapInArrow(mix, schema).select("block", "value"), "network")
        got = {r["block"]: r["value"] for r in whole.collect()}  # one network: its size is fixed
        if got:
            net = Network.of(np.concatenate([np.frombuffer(bytes(got[b]), "<f4") for b in sorted(got)]))
    return net


_LOW = np.uint64((1 << 48) - 1)  # of a context's or word's hash
#: Occurrences of rare words: rec (its document), context, word, prior (log of the network's share; by word still without the word's count).
_OCCURRENCE = np.dtype([("rec", "<i8"), ("context", "<u8"), ("word", "<u8"), ("prior", "<f4")])
_STEPS = 1024  # of a prior to one, as it travels: within 0.0005 of its value


def _narrow(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _wide(raw, n: int, at: int, size: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8, size * n, at).reshape(-1, size)
    return out.view("<u8").ravel()


def _pack(x: np.ndarray, size: int) -> bytes:
    """Occurrences in order of rec: records, how many each has, then six bytes of each context, size of each word, priors."""
    rec, n = np.unique(x["rec"], return_counts=True)
    prior = np.clip(np.round(x["prior"] * -_STEPS), 0, 65535).astype("<u2")
    return np.uint32(len(rec)).tobytes() + rec.tobytes() + n.astype("<u4").tobytes() + _narrow(x["context"], 6) + _narrow(x["word"], size) + prior.tobytes()


def _unpack(blob, size: int) -> np.ndarray:
    k = int(np.frombuffer(blob, "<u4", 1)[0])
    rec, n = np.frombuffer(blob, "<i8", k, 4), np.frombuffer(blob, "<u4", k, 4 + 8 * k)
    m, at = int(n.sum()), 4 + 12 * k
    out = np.zeros(m, _OCCURRENCE)
    out["rec"], out["context"], out["word"] = np.repeat(rec, n), _wide(blob, m, at, 6), _wide(blob, m, at + 6 * m, size)
    out["prior"] = np.frombuffer(blob, "<u2", m, at + (6 + size) * m) / np.float32(-_STEPS)
    return out


#: Bytes of a word's hash: among all words, and among those of one context.
WORD_BYTES = {BY_WORD: 6, BY_CONTEXT: 4, COUNTS: 4, CROWDED: 4}


def _dealt(x: np.ndarray, kind: int, key: str, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(kind, bucket, blob) of occurrences by a hash of the key."""
    bucket = (K.mix(x[key] & _LOW) >> np.uint64(40)) % np.uint64(buckets)
    order = np.lexsort((x["rec"], bucket))
    x, bucket = x[order], bucket[order]
    keys, first = np.unique(bucket, return_index=True)
    for k, a, b in zip(keys.tolist(), first.tolist(), [*first[1:].tolist(), len(x)], strict=True):
        yield kind, k, _pack(x[a:b], WORD_BYTES[kind])


def _by_context(x: np.ndarray, buckets: int, most: int) -> Iterator[tuple[int, int, bytes]]:
    """Occurrences by context; those of crowded contexts stay where they are, and send combined counts (as rec)."""
    x["word"] &= np.uint64((1 << 8 * WORD_BYTES[BY_CONTEXT]) - 1)
    x["context"] &= _LOW
    own, inverse, n = np.unique(x["context"], return_inverse=True, return_counts=True)
    crowd = (n > most)[inverse]
    if crowd.any():
        many = x[crowd]
        pair, first, n = np.unique(many[["context", "word"]], return_index=True, return_counts=True)
        counts = many[first]
        counts["rec"] = n
        yield from _dealt(counts, COUNTS, "context", buckets)
        yield CROWDED, -1, _pack(many[np.argsort(many["rec"], kind="stable")], WORD_BYTES[CROWDED])
    if not crowd.all():
        yield from _dealt(x[~crowd], BY_CONTEXT, "context", buckets)


def _score(prior: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.log((a + PRIOR * np.exp(prior.astype(np.float64))) / (b + PRIOR))


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, part, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(blob, pa.binary())], ["kind", "part", "blob"])


#: Packed bytes of a bucket that a task unpacks at a time; numpy's arrays of them are several times that.
OPENED = 16 << 20


def _opened(table: pa.Table, kind: int, key: str = "context", part: int = 0, parts: int = 1) -> np.ndarray:
    """Occurrences of a kind in a bucket; of parts by a hash of the key, one. Blobs are unpacked one at a time."""
    got = [np.zeros(0, _OCCURRENCE)]
    for k, blob in zip(table.column("kind").to_pylist(), table.column("blob"), strict=True):
        if k == kind:
            x = _unpack(blob.as_buffer(), WORD_BYTES[kind])
            got.append(x if parts == 1 else x[(K.mix(x[key] & _LOW) & np.uint64(0xFFFFFFFF)) % np.uint64(parts) == part])
    return np.concatenate(got)


def _parts(table: pa.Table, most: int) -> int:
    """Parts in which a bucket is opened, so that each has about most packed bytes."""
    return max(1, -(-table.column("blob").nbytes // most))


def score(docs: DataFrame, names: Vocabulary, net: Network, id_col: str = "doc_id", text_col: str = "text", crowd_of: int = CROWD, opened: int = OPENED) -> DataFrame:
    """doc_id, n_tokens, log_prob (natural logarithm, summed over all words), mean_log_prob (null without words).

    The contexts and the counts of words beyond the vocabulary are those of docs. A bucket grows with
    the bytes of a scan's task; a task unpacks about opened packed bytes of it at a time.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    flat = net.flat()
    buckets = min(1 << 16, max(16, storage.scan_partitions(docs)))
    columns = ["kind", "part", "blob", "rec", "doc_id", "n", "total"]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, rec = Network.of(flat), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        rare_total = np.log(np.maximum(names.total, 1))
        held: list[list[np.ndarray]] = [[], []]  # words without a count yet, and with
        type_ = None

        def flush() -> Iterator[pa.RecordBatch]:
            out: list[tuple[int, int, bytes]] = []
            if held[0]:
                out += _dealt(np.concatenate(held[0]), BY_WORD, "word", buckets)
            if held[1]:
                out += _by_context(np.concatenate(held[1]), buckets, crowd_of)
            held[:] = [[], []]
            if out:
                packed = _batch(out)
                yield pa.RecordBatch.from_arrays([*packed.columns, *(pa.nulls(len(out), t) for t in (pa.int64(), type_, pa.int64(), pa.float64()))], columns)

        for batch in batches:
            type_ = batch.column(0).type
            for part, texts in K.Texts.of(batch.column(1)).chunks():
                context, target, w, at, known = examples(texts, names)
                p, any_rare = np.zeros(len(target)), np.zeros(len(target))
                for i in range(0, len(target), BATCH):
                    p[i : i + BATCH], any_rare[i : i + BATCH] = own.log_probabilities(context[i : i + BATCH], target[i : i + BATCH])
                rare, owner, n = np.flatnonzero(target >= HEADS), w.owner(), np.diff(w.first)
                total = K.sums(np.where(target >= HEADS, any_rare, p), w.first)
                empty = [pa.nulls(len(n), t) for t in (pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), DOCUMENT, np.int32)), *empty, pa.array(rec + np.arange(len(n))), batch.column(0).slice(part.start, len(n)), pa.array(n, pa.int64()), pa.array(total)], columns)
                left, right = np.full(len(owner), _EDGE), np.full(len(owner), _EDGE)
                inner = np.flatnonzero(owner[1:] == owner[:-1])
                left[inner + 1], right[inner] = w.hash[inner], w.hash[inner + 1]
                x = np.zeros(len(rare), _OCCURRENCE)
                x["rec"], x["word"] = rec + owner[rare], w.hash[rare]
                x["context"] = K.mix(left[rare] + K.mix(right[rare]))
                count = names.count[at[rare]] if len(names.count) else np.ones(len(rare))
                x["prior"] = (p - any_rare)[rare] - rare_total[target[rare]] + np.where(known[rare], np.log(count), 0)
                for side, own_words in zip(held, (x[~known[rare]], x[known[rare]]), strict=True):
                    if len(own_words):
                        side.append(own_words)
                rec += len(n)
                if sum(len(y) for side in held for y in side) > FLUSH:
                    yield from flush()
        yield from flush()

    told = storage.written(rows.mapInArrow(tell, f"kind int, part int, blob binary, rec long, doc_id {kind}, n long, total double"), "occurrences")

    def count(table: pa.Table) -> pa.Table:
        """All occurrences of a bucket's words: their counts complete the priors."""
        out: list[tuple[int, int, bytes]] = []
        parts = _parts(table, opened)
        for part in range(parts):
            x = _opened(table, BY_WORD, "word", part, parts)
            _, inverse, n = np.unique(x["word"], return_inverse=True, return_counts=True)
            x["prior"] += np.log(n)[inverse].astype(np.float32)
            x["word"] &= np.uint64((1 << 8 * WORD_BYTES[BY_CONTEXT]) - 1)
            out += _dealt(x, BY_CONTEXT, "context", buckets)
        return pa.Table.from_batches([_batch(out)])

    # a word beyond the vocabulary has a small share of all words, so its contexts crowd no bucket
    blobs = told.select("kind", "part", "blob")
    counted = blobs.where(F.col("kind") == BY_WORD).groupBy("part").applyInArrow(count, "kind int, part int, blob binary")

    def weigh(x: np.ndarray, crowd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums by document (rec, total) of all occurrences of some contexts; totals (first rows, a, b) of crowded ones."""
        both = np.concatenate([x[["context", "word"]], crowd[["context", "word"]]])
        weight = np.concatenate([np.ones(len(x), np.int64), crowd["rec"]])
        order = np.lexsort((both["word"], both["context"]))
        both = both[order]
        new = np.ones(len(both), bool)
        new[1:] = both["context"][1:] != both["context"][:-1]
        pair = new.copy()
        pair[1:] |= both["word"][1:] != both["word"][:-1]
        a, b = np.zeros(len(both), np.int64), np.zeros(len(both), np.int64)
        for out, run in ((a, pair), (b, new)):
            which = np.cumsum(run) - 1
            out[order] = np.bincount(which, weight[order])[which].astype(np.int64) - 1 if len(both) else 0
        rec, inverse = np.unique(x["rec"], return_inverse=True)
        total = np.bincount(inverse, _score(x["prior"], a[: len(x)], b[: len(x)]), minlength=len(rec))
        some = np.unique(crowd[["context", "word"]], return_index=True)[1]
        return rec, total, crowd[some], a[len(x) :][some], b[len(x) :][some]

    def meet(table: pa.Table) -> pa.Table:
        """All occurrences of a bucket's contexts, or their counts: sums by document, and totals for crowded contexts."""
        parts = _parts(table, opened)
        found = [weigh(*(_opened(table, kind, "context", part, parts) for kind in (BY_CONTEXT, COUNTS))) for part in range(parts)]
        rec, total, some, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        rec, inverse = np.unique(rec, return_inverse=True)
        total = np.bincount(inverse, total, minlength=len(rec))
        kinds = np.repeat([SUM, TOTAL], [len(rec), len(some)])
        none = np.zeros(len(rec), np.int64)
        columns = [kinds, np.concatenate([rec, some["context"].view(np.int64)]), *(np.concatenate([none, y]) for y in (some["word"].view(np.int64), a, b)), np.concatenate([total, np.zeros(len(some))])]
        return pa.table({name: pa.array(y).cast(t) for name, y, t in zip(("kind", "key", "word", "a", "b", "total"), columns, (pa.int32(), *[pa.int64()] * 4, pa.float64()), strict=True)})

    met = blobs.where(F.col("kind").isin(BY_CONTEXT, COUNTS)).unionByName(counted).groupBy("part").applyInArrow(meet, "kind int, key long, word long, a long, b long, total double")
    met = storage.written(met, "met")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                x = _unpack(blob.as_buffer(), WORD_BYTES[CROWDED])
                yield pa.RecordBatch.from_arrays([pa.array(x["rec"]), pa.array(x["context"].copy().view(np.int64)), pa.array(x["word"].copy().view(np.int64)), pa.array(x["prior"].astype(np.float64))], ["rec", "key", "word", "prior"])

    crowd = blobs.where(F.col("kind") == CROWDED).select("blob").mapInArrow(each, "rec long, key long, word long, prior double")
    totals = met.where(F.col("kind") == TOTAL).select("key", "word", "a", "b")
    share = F.log((F.col("a") + F.lit(PRIOR) * F.exp("prior")) / (F.col("b") + F.lit(PRIOR)))
    sums = met.where(F.col("kind") == SUM).select(F.col("key").alias("rec"), "total").unionByName(crowd.join(totals, ["key", "word"]).select("rec", share.alias("total")))
    sums = sums.groupBy("rec").agg(F.sum("total").alias("rare"))
    log_prob = F.col("total") + F.coalesce("rare", F.lit(0.0))
    out = told.where(F.col("kind") == DOCUMENT).join(sums, "rec", "left").withColumn("log_prob", log_prob)
    return out.select("doc_id", F.col("n").alias("n_tokens"), "log_prob", F.when(F.col("n") > 0, F.col("log_prob") / F.col("n")).alias("mean_log_prob"))


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on all documents and score each of them: doc_id, n_tokens, log_prob, mean_log_prob.

    Null and empty texts have no words: log_prob 0, mean null. Repeated rows and null ids are scored
    each; copies are occurrences of each other's contexts, so their words score higher. An empty
    table gives an empty result. Scores depend a little on how the rows lie in partitions (see train).
    """
    names = count_words(docs, text_col)
    return score(docs, names, train(docs, names, text_col), id_col, text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_and_score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
