"""Quality rules: per-document counts, and cross-document line frequency per host.

Lines are normalised (A-Z lower-cased, words joined by one space) and hashed. A line found in more
than a share of its host's distinct documents is boilerplate; a document that loses too much of its
words with such lines is depleted and rejected; a kept one goes on without them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from . import textkit as K

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words that may stand in repeated three-word windows
LINE_SHARE, LINE_LEAST = 0.05, 20  # a line is boilerplate beyond this share of its host's documents, and this many
LEFT_SHARE = 0.3  # least share of the words that must be left without boilerplate
SYMBOLS = b"#*$%&|<>"
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))


def line_keys(texts: K.Texts, w: K.Spans | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines with a word: text number, line number in its text, words, hash of the lower-cased words in order. w: the lower-cased words, where they are known."""
    w = K.words(texts, lower=True) if w is None else w
    start, end, first = K.lines(texts)
    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    number = np.arange(len(start)) - first[owner]
    has = b > a
    return owner[has], number[has], (b - a)[has], K.run_hash(w.hash, a[has], b[has])


def _marks(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether (owner, key) occurs twice or more."""
    both = K.mix(key + K.mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both)
    s = both[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    out = np.zeros(len(s), bool)
    out[order] = same[1:] | same[:-1]
    return out


def base_counts(texts: K.Texts) -> np.ndarray:
    """Rows n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = K.words(texts, lower=False)
    d = texts.data
    counted = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[texts.bounds])
    chars = counted((d & 0xC0) != 0x80) - counted(K._SPACE[d])
    start, end, first = K.lines(texts)
    solid = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))[solid]
    dup, raw = np.bincount(owner, minlength=len(texts)), d.tobytes()
    lines = [raw[a:b] for a, b in zip(start[solid].tolist(), end[solid].tolist(), strict=True)]
    bounds = np.concatenate([[0], np.cumsum(dup)])
    dup = dup - np.array([len(set(lines[a:b])) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], np.int64)
    h, window_owner = K.windows(w.hash, w.first, 3)
    again = _marks(window_owner, h)
    n = np.diff(w.first)
    repeated = np.zeros(len(w.hash) + 1, bool)
    if len(h):
        at = w.first[window_owner] + np.arange(len(h)) - np.searchsorted(window_owner, window_owner)
        for k in range(3):
            repeated[at[again] + k] = True
    words_in = np.diff(np.concatenate([[0], np.cumsum(repeated[:-1])])[w.first])
    return np.stack([n, chars, counted(_SYMBOL[d]), dup, words_in])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Each row's counts and verdict: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, boilerplate_words, boilerplate_lines (their numbers), text_key, host.

    Null and empty texts have no words and fail. A null host is a host of its own. Documents of equal
    text count once for a line's frequency, so copies of a document don't make its lines
    boilerplate. Repeated rows are judged each; a null id is returned.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host")).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row_key = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        for batch in batches:
            for part, texts in K.Texts.of(batch.column("text")).chunks():
                base = base_counts(texts)
                owner, number, n, key = line_keys(texts)
                first = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                lines = pa.ListArray.from_arrays(pa.array(first), pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64()), pa.array(number, pa.int32())], ["key", "n", "pos"]))
                here = [batch.column(c).slice(part.start, len(texts)) for c in ("doc_id", "host", "text_key")]
                yield pa.RecordBatch.from_arrays([pa.array(row_key + np.arange(len(texts))), *here, *(pa.array(x, pa.int64()) for x in base), lines], ["row_key", "doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])
                row_key += len(texts)

    measured = storage.written(rows.mapInArrow(measure, f"row_key long, doc_id {kind}, host string, text_key long, {_BASE}, lines array<struct<key: long, n: long, pos: int>>"), "measured")
    line = measured.select("row_key", "host", "text_key", F.explode("lines").alias("line")).select("row_key", "host", "text_key", F.col("line.key").alias("key"), F.col("line.n").alias("n"), F.col("line.pos").alias("pos"))
    limits = measured.select("host", "text_key").distinct().groupBy("host").agg(F.greatest(F.lit(LINE_LEAST), F.floor(F.count("*") * LINE_SHARE)).alias("limit"))
    found = line.select("host", "key", "text_key").distinct().groupBy("host", "key").agg(F.count("*").alias("documents")).where(F.col("documents") > LINE_LEAST)
    common = found.join(limits, "host").where("documents > limit").select("host", "key")
    lost = line.join(common, ["host", "key"]).groupBy("row_key").agg(F.sum("n").alias("lost"), F.sort_array(F.collect_list("pos")).alias("places"))
    out = measured.drop("lines").join(lost, "row_key", "left").withColumn("boilerplate_words", F.coalesce("lost", F.lit(0))).withColumn("boilerplate_lines", F.coalesce("places", F.array().cast("array<int>")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    whole = F.col("n_words") - F.col("boilerplate_words") >= LEFT_SHARE * F.col("n_words")
    out = out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & whole)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "boilerplate_words", "boilerplate_lines", "text_key", "host")


def without_lines(text: Column, places: Column) -> Column:
    """The text without the \n-split lines of these numbers."""
    # the lines are bound to a name by a transform of one element: a split inside the inner one would be made anew for each line
    left = lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), places), lambda i: F.get(x, i)), "\n")
    return F.transform(F.array(F.split(text, "\n", -1)), left)[0]


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of docs that judge() keeps, with the columns of docs; their text is without its boilerplate lines.

    Null and empty texts go. Rows that repeat id, text and host stay or go together, as do rows with a
    null id; a null host is a host. An empty table gives an empty result.
    """
    own_id, key, host, places = K.unused(docs.columns, "id", "key", "host", "places")
    good = judge(docs, id_col, text_col, host_col).where("kept").select("doc_id", "text_key", "host", "boilerplate_lines").toDF(own_id, key, host, places).dropDuplicates([own_id, key, host])
    text = docs[text_col].cast("string")
    on = docs[id_col].eqNullSafe(good[own_id]) & (F.xxhash64(F.coalesce(text, F.lit(""))) == good[key]) & (F.coalesce(docs[host_col].cast("string"), F.lit("")) == good[host])
    left = F.when(F.size(good[places]) == 0, text).otherwise(without_lines(text, good[places]))
    return docs.join(good, on).select(*(left.alias(c) if c == text_col else docs[c] for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("boilerplate_words", "boilerplate_lines", "text_key", "host")


ORACLE_SQL = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rk, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
w AS MATERIALIZED (SELECT rk, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
g AS (SELECT rk, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rk, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (
  SELECT rk, count(DISTINCT i + k) AS n FROM (SELECT rk, i, count(*) OVER (PARTITION BY rk, g) AS c FROM g), (SELECT unnest([0, 1, 2]) AS k)
  WHERE c > 1 GROUP BY rk),
l AS MATERIALIZED (SELECT rk, host, text, line, list_transform(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws
  FROM (SELECT rk, host, text, unnest(string_split(text, chr(10))) AS line FROM d)),
s AS MATERIALIZED (SELECT rk, host, text, line, array_to_string(ws, ' ') AS norm, len(ws) AS n FROM l WHERE len(ws) > 0),
dup AS (SELECT rk, count(*) - count(DISTINCT line) AS n FROM s GROUP BY rk),
lim AS (SELECT host, greatest({LINE_LEAST}, floor(count(DISTINCT text) * {LINE_SHARE}::DOUBLE)) AS m FROM d GROUP BY host),
common AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS c FROM s GROUP BY host, norm) JOIN lim USING (host) WHERE c > m),
lost AS (SELECT rk, sum(n) AS n FROM s JOIN common USING (host, norm) GROUP BY rk),
f AS (
  SELECT d.rk, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0) AS lost
  FROM d JOIN w USING (rk) LEFT JOIN dup ON dup.rk = d.rk LEFT JOIN rep ON rep.rk = d.rk LEFT JOIN lost ON lost.rk = d.rk),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - lost >= {LEFT_SHARE}::DOUBLE * n_words AS kept FROM b
"""
