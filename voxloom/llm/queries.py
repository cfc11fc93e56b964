"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import licenses, lines, lm, media, packing, pieces, quality, setjoin, sharding, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": licenses.query,
    "op2_best_fit_packing": packing.query,
    "op3_url_filter": urls.query,
    "op4_ngram_jaccard_join": setjoin.query,
    "op5_quality_rules": quality.query,
    "op6_sentencepiece": pieces.query,
    "op7_media_columns": media.query,
    "op8_sharding": sharding.query,
    "op9_line_dedup": lines.query,
    "op10_lm_scoring": lm.query,
}
ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": licenses.ORACLE_SQL,
    "op5_quality_rules": quality.ORACLE_SQL,
}
