"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in cells of source, language and topic, weighed by tokens. Token weights of the cells are raked to
the target shares of one margin after the other, round after round; no cell may get more tokens than it has, and what it
cannot give the others of its margins make up in the next round. A document's sampling probability is its cell's raked
weight over its tokens, and a hash of its id decides, so that the same documents are drawn on every run.

Targets default to the observed token shares tempered by ``TEMPER``: shares below 1 favour small sources, languages and
topics. Cells and margins stay in tables; the sums of a margin are combined before they are shuffled, so a source that
holds a third of all documents costs one row per task.

Null source, language or topic is a value of its own, written ''. Null or empty text counts one token. Rows without
doc_id are drawn by their text. Repeated rows are drawn together. An empty table gives an empty result. Only DataFrame
functions are used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmart.llm.common import columns_of, fresh, saved

MARGINS = ("source", "lang", "topic")
#: Share of all tokens that the sample should hold, rounds of raking, exponent of the observed shares.
BUDGET = 0.6
ROUNDS = 8
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 1.0}
#: The first topic one of whose strings occurs in the lower-cased text; otherwise the last.
TOPICS = (
    ("legal", ("license", "copyright", "warranty")),
    ("contact", ("@", "phone")),
    ("web", ("http", "www.")),
    ("symbols", ("***", "$$$", "%%%", "###")),
)
REST = "general"


def topic(text: Column | str = "text") -> Column:
    lower = F.lower(text) if isinstance(text, str) else F.lower(text)
    chain = F
    for name, words in TOPICS:
        hit = F.lit(False)
        for word in words:
            hit = hit | lower.contains(word)
        chain = chain.when(hit, name)
    return F.when(lower.isNull(), REST).otherwise(chain.otherwise(REST))


def tokens(text: str = "text") -> Column:
    """Words between single spaces."""
    spaces = F.length(text) - F.length(F.replace(F.col(text), F.lit(" "), F.lit("")))
    return (F.coalesce(spaces, F.lit(0)) + 1).cast("long")


def chance(doc_id: str = "doc_id", text: str = "text", seed: str = "mix") -> Column:
    """A number from 0 to 1, the same for the same document."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.col(text).cast("binary")), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}-"), key).cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, the margins, tokens and the chance of each document."""
    return docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        topic().alias("topic"),
        tokens().alias("tokens"),
        chance().alias("chance"),
    )


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, share): observed token shares to the given power, made to add up to 1."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("sum"))
    raised = sums.select(margin, F.pow("sum", F.lit(power)).alias("raised"))
    total = raised.agg(F.sum("raised").alias("total"))
    return raised.join(F.broadcast(total)).select(margin, (F.col("raised") / F.col("total")).alias("share"))


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame] | None = None,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    margins: Sequence[str] = MARGINS,
) -> DataFrame:
    """Cells with the probability of their documents.

    ``targets`` has, for each margin, a frame (margin, share); values without a target get no weight.
    """
    cells = saved(cells.select(*margins, "tokens"))
    total = cells.agg(F.sum("tokens").cast("double").alias("all_tokens"))
    goals = {}
    for margin in margins:
        shares = targets[margin] if targets and margin in targets else tempered(cells, margin, TEMPER[margin])
        goals[margin] = saved(
            shares.join(F.broadcast(total)).select(margin, (F.col("share") * F.col("all_tokens") * budget).alias("goal"))
        )
    raked = cells.withColumn("weight", F.col("tokens").cast("double"))
    for margin in margins:
        raked = raked.join(goals[margin].withColumnRenamed("goal", f"goal_{margin}"), margin, "left")
    goal_columns = [f"goal_{margin}" for margin in margins]
    raked = saved(raked.select(*margins, "tokens", "weight", *goal_columns))
    for _ in range(rounds):
        for margin in margins:
            sums = raked.groupBy(margin).agg(F.sum("weight").alias("sum")).where("sum > 0")
            grown = F.coalesce(F.col("weight") * (F.col(f"goal_{margin}") / F.col("sum")), F.lit(0.0))
            weight = F.least(F.col("tokens").cast("double"), grown).alias("weight")
            # saved each time: a step reads the one before twice, so unsaved plans would double with every margin
            raked = saved(raked.join(sums, margin, "left").select(*margins, "tokens", weight, *goal_columns))
    return raked.select(*margins, F.round(F.col("weight") / F.col("tokens"), 6).alias("probability"))


def mixture(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """Per row: doc_id, source, lang, topic, tokens, probability, sampled."""
    rows = saved(described(docs))
    cells = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    rates = rake(cells, targets, budget)
    return rows.join(rates, list(MARGINS)).select(
        "doc_id", *MARGINS, "tokens", "probability", (F.col("chance") < F.col("probability")).alias("sampled")
    )


def sample(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The rows, all columns kept, that the mixture draws."""
    cells = described(docs).groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    rates = rake(cells, targets, budget)
    named = {"source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "topic": topic()}
    keys = {margin: fresh(docs, f"of_{margin}") for margin in MARGINS}
    drawn, rate = fresh(docs, "chance"), fresh(docs, "probability")
    rates = rates.select(*[F.col(m).alias(keys[m]) for m in MARGINS], F.col("probability").alias(rate))
    rows = docs.withColumns({keys[m]: named[m] for m in MARGINS} | {drawn: chance()})
    kept = rows.join(rates, list(keys.values())).where(F.col(drawn) < F.col(rate))
    return kept.select(*columns_of(docs))


def mixture_sql(budget: float = BUDGET, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for :func:`mixture` over ``documents`` with the default targets."""
    cases = " ".join(
        f"WHEN {' OR '.join(f'contains(lower(text), {chr(39)}{word}{chr(39)})' for word in words)} THEN '{name}'"
        for name, words in TOPICS
    )
    parts = [
        f"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        CASE WHEN text IS NULL THEN '{REST}' {cases} ELSE '{REST}' END AS topic,
        coalesce(length(text) - length(replace(text, ' ', '')), 0) + 1 AS tokens,
        CAST(CAST('0x' || substr(md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 12) AS BIGINT)
             AS DOUBLE) / 281474976710656.0 AS chance FROM documents)""",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS tokens, CAST(sum(tokens) AS DOUBLE) AS weight "
        "FROM d GROUP BY ALL)",
    ]
    for margin in MARGINS:
        parts.append(
            f"goal_{margin} AS MATERIALIZED (SELECT {margin}, power(s, {TEMPER[margin]}) / sum(power(s, {TEMPER[margin]})) "
            f"OVER () * (SELECT CAST(sum(tokens) AS DOUBLE) FROM c0) * {budget} AS goal FROM "
            f"(SELECT {margin}, CAST(sum(tokens) AS DOUBLE) AS s FROM c0 GROUP BY ALL))"
        )
    at = 0
    for _ in range(rounds):
        for margin in MARGINS:
            parts.append(
                f"c{at + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, tokens, least(CAST(tokens AS DOUBLE), "
                f"coalesce(weight * (goal / s), 0.0)) AS weight FROM c{at} c LEFT JOIN (SELECT {margin}, sum(weight) AS s "
                f"FROM c{at} GROUP BY ALL) m ON c.{margin} = m.{margin} AND s > 0 LEFT JOIN goal_{margin} g "
                f"ON c.{margin} = g.{margin})"
            )
            at += 1
    return (
        "WITH " + ",\n".join(parts) + f" SELECT d.doc_id, d.source, d.lang, d.topic, CAST(d.tokens AS BIGINT) AS tokens, "
        f"round(weight / c.tokens, 6) AS probability, chance < round(weight / c.tokens, 6) AS sampled "
        f"FROM d JOIN c{at} c USING (source, lang, topic)"
    )
