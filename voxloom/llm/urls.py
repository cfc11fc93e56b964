"""URL filters: host word segmentation by unigram Viterbi, then multinomial naive Bayes; rules come first.

Words for the segmentation are counted over the tag-free text of all pages. Naive Bayes learns from
the URLs that rules judge and judges those that no rule fits.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed by the query's contract: verdict and rule.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
LONGEST_WORD = 24
#: Size of the word model, and of the labelled sample that naive Bayes is fitted on.
VOCABULARY, LABELLED = 50_000, 20_000
SMOOTHING = 1.0
_SPLIT = re.compile(r"[^a-z]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ://."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, begins = text.split("/", 1)
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + begins)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


class WordModel:
    """Unigram log-probabilities of words and the most probable split of a name."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.score = {w: math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(1 / total)  # of a letter that stands in no word
        self.segment = lru_cache(maxsize=1 << 16)(self._segment)

    def _segment(self, name: str) -> tuple[str, ...]:
        """Ties go to the shorter last word of more than one letter; letters that no word covers stand alone."""
        best, back = [0.0], [0]
        for j in range(1, len(name) + 1):
            top, at = best[j - 1] + self.score.get(name[j - 1], 2 * self.unknown), j - 1
            for i in range(max(0, j - LONGEST_WORD), j - 1):
                s = self.score.get(name[i:j])
                if s is not None and best[i] + s >= top:
                    top, at = best[i] + s, i
            best.append(top)
            back.append(at)
        out, j = [], len(name)
        while j:
            out.append(name[back[j] : j])
            j = back[j]
        return tuple(reversed(out))

    def tokens(self, host: str, path: str) -> list[str]:
        words = [w for part in _SPLIT.split(host) if part for w in self.segment(part)]
        return words + ["/" + p for p in _SPLIT.split(path.translate(str.maketrans(UPPER, LOWER))) if p]


class NaiveBayes:
    """Multinomial naive Bayes of two classes with additive smoothing; a tie is allowed."""

    def __init__(self, rows: list[tuple[list[str], str]]):
        seen = {"allow": Counter(), "block": Counter()}
        of = Counter(says for _, says in rows)
        for tokens, says in rows:
            seen[says].update(tokens)
        self.vocabulary = set(seen["allow"]) | set(seen["block"])
        size = len(self.vocabulary) or 1
        self.prior = math.log((of["block"] + 1) / (of["allow"] + 1))
        whole = {k: sum(c.values()) + SMOOTHING * size for k, c in seen.items()}
        self.weight = {t: math.log((seen["block"][t] + SMOOTHING) / whole["block"]) - math.log((seen["allow"][t] + SMOOTHING) / whole["allow"]) for t in self.vocabulary}

    def score(self, tokens: list[str]) -> float:
        return self.prior + sum(self.weight.get(t, 0.0) for t in tokens)


def fit_words(pages: DataFrame, html_col: str = "html", size: int = VOCABULARY) -> WordModel:
    """Counts every page's words; the size most frequent ones make the model (ties in order of the words)."""
    text = F.regexp_replace(F.col(html_col), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    word = F.explode(F.split(F.translate(text, UPPER, LOWER), "[^a-z]+")).alias("word")
    counts = pages.select(word).where(f"length(word) between 1 and {LONGEST_WORD}").groupBy("word").count()
    return WordModel({r["word"]: r["count"] for r in counts.orderBy(F.desc("count"), "word").limit(size).collect()})


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, vocabulary: int = VOCABULARY, labelled: int = LABELLED) -> DataFrame:
    """page_id, host, path, rule, verdict, score (of block against allow; null where a rule decides).

    A null url, or one without ://, has an empty host and path, no rule, and the verdict of the
    prior. Repeated rows and null ids are judged each. An empty table gives an empty result. The
    driver holds two bounded models: vocabulary words, and the tokens of labelled sampled urls.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("says", says)
    words = fit_words(pages, html_col, vocabulary)
    sample = rows.where("rule is not null").select("host", "path", "says").orderBy(F.xxhash64("host", "path"), "host", "path").limit(labelled).collect()
    bayes = NaiveBayes([(words.tokens(r["host"], r["path"]), r["says"]) for r in sample])
    counts, fitted = (words.score, words.unknown), (bayes.prior, bayes.weight)
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, nb = WordModel({}), NaiveBayes([])
        model.score, model.unknown = counts
        nb.prior, nb.weight = fitted
        for batch in batches:
            rule, says = batch.column("rule").to_pylist(), batch.column("says").to_pylist()
            scores = [None if r is not None else nb.score(model.tokens(h, p)) for r, h, p in zip(rule, batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            verdict = [s if s is not None else "block" if x > 0 else "allow" for s, x in zip(says, scores, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path", "rule")), pa.array(verdict, pa.string()), pa.array(scores, pa.float64())], ["page_id", "host", "path", "rule", "verdict", "score"])

    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
