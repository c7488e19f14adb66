"""The pN_ queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvinlake.llm import mixing, moderation, nearest, packing, tokens
from kelvinlake.session import spread, table, written

TOLERANCE_K = 4.0


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each temperature-resolved ZT point with the nearest state of the same sample of the same paper."""
    points = table(spark, sf_dir, "fact_measurements").filter((F.col("property_id_y") == 16) & (F.col("property_id_x") == 1))
    states = table(spark, sf_dir, "interpolated_states").withColumn("sample_key", F.expr(r"try_cast(regexp_replace(sampleid, '^\\s+|\\s+$', '') AS int)"))
    pairs = nearest.nearest_pairs(
        points, states.withColumnsRenamed({"sampleid": "sampleid_text", "sample_key": "sample_id", "paperid": "paper_id"}), ("paper_id", "sample_id"), "x_si", "temperature", "measurement_id", "row_id", TOLERANCE_K
    )
    return pairs.select(F.col("left_id").alias("measurement_id"), F.col("right_id").alias("row_id"))


def _kinds(spark: SparkSession, sf_dir: str) -> list[tuple[str, int]]:
    """The container kinds: a fixed configuration table."""
    return [(r["pack_kind"], r["capacity_tokens"]) for r in table(spark, sf_dir, "pack_sizes").orderBy("capacity_tokens").collect()]


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[str, int]]]:
    kinds = _kinds(spark, sf_dir)
    counts = written(tokens.token_counts(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "text", ["doc_id"]), "token-counts")
    return packing.pack_documents(counts, kinds), kinds


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its container, for each kind of container."""
    return _packed(spark, sf_dir)[0]


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used against the least possible number, and the share of room used."""
    return packing.packing_report(*_packed(spark, sf_dir))


def _targets(spark: SparkSession, sf_dir: str) -> list[mixing.Target]:
    """The target shares: a fixed configuration table."""
    return [mixing.Target(r["source"], r["target_share"], r["max_repeats"]) for r in table(spark, sf_dir, "mix_targets").orderBy("source").collect()]


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is used in the mixture."""
    return mixing.mix(table(spark, sf_dir, "documents"), _targets(spark, sf_dir)).drop("posterior")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of tokens each source reaches, by label and by soft domain, beside its target."""
    targets = _targets(spark, sf_dir)
    return mixing.shares(mixing.mix(table(spark, sf_dir, "documents"), targets), targets)


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return moderation.score_documents(documents, moderation.Moderator.fit(documents, table(spark, sf_dir, "moderation_examples")))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least one abusive, hateful or sexual passage."""
    return _scores(spark, sf_dir).filter(F.col("score") >= moderation.THRESHOLD).select("doc_id")


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, category and worst passage of every document."""
    return _scores(spark, sf_dir)


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of such content per source."""
    return moderation.rates(_scores(spark, sf_dir))


QUERIES = {f.__name__: f for f in (p2_found, p7_packing, p7_report, p8_mixture, p8_shares, p9_found, p9_scores, p9_rates)}

ORACLE = {
    "p2_found": """
WITH s AS (SELECT paperid AS paper_id, TRY_CAST(trim(sampleid) AS INTEGER) AS sample_id, temperature, min(row_id) AS row_id
           FROM interpolated_states WHERE temperature IS NOT NULL GROUP BY 1, 2, 3)
SELECT measurement_id, s.row_id FROM fact_measurements m JOIN s ON s.paper_id = m.paper_id AND s.sample_id = m.sample_id AND abs(m.x_si - s.temperature) <= 4
WHERE m.property_id_y = 16 AND m.property_id_x = 1
QUALIFY row_number() OVER (PARTITION BY measurement_id ORDER BY abs(m.x_si - s.temperature), s.temperature) = 1
""",
}
