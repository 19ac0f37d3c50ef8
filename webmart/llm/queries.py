"""The registered queries of this package; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmart.llm import (
    language_id,
    line_dedup,
    mixing,
    neighbours,
    order_minhash,
    page_text,
    periodic_runs,
    pieces,
    secret_scan,
    simhash,
    spelling,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(documents(spark, sf_dir))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.learn(docs))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_pairs(documents(spark, sf_dir))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.scan_secrets(documents(spark, sf_dir)))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(url_filter.dated_captures(pages), url_filter.drawn_entries(pages))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encoding_digests(documents(spark, sf_dir), model)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.misspelt_vocabulary(documents(spark, sf_dir)))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.with_planted_periods(documents(spark, sf_dir))
    return periodic_runs.run_digests(periodic_runs.find_runs(planted))


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_language": op2_language,
        "op3_toxicity": op3_toxicity,
        "op4_simhash": op4_simhash,
        "op5_order_minhash": op5_order_minhash,
        "op6_secrets": op6_secrets,
        "op7_mixing": op7_mixing,
        "op8_neighbours": op8_neighbours,
        "op9_url_filter": op9_url_filter,
        "op10_pieces": op10_pieces,
        "op11_spelling": op11_spelling,
        "op12_page_text": op12_page_text,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_mixing": mixing.mixture_sql(), "op9_url_filter": url_filter.judge_sql()}
