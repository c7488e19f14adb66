"""Whole pipelines over the operators: corpus build, publication dataset, before-and-after report, record scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvinlake.functions import constants as K
from kelvinlake.functions import physics, quality, text
from kelvinlake.operators import clean, states, stats
from kelvinlake.session import written
from kelvinlake.sinks import writers
from kelvinlake.sources import corpus, tabular


@dataclass(frozen=True)
class PipelineResult:
    """Counts of a run; none is negative, and inserted plus failed never exceed processed."""

    processed: int
    inserted: int
    failed: int
    violations: int
    mean_zt: float
    max_zt: float

    def __post_init__(self):
        if min(self.processed, self.inserted, self.failed, self.violations) < 0 or self.inserted + self.failed > self.processed:
            raise ValueError(f"inconsistent result {self}")


def build_corpus(spark: SparkSession, roots: dict[str, str], out: str | None = None) -> dict[str, DataFrame]:
    """From folders of JSON files per domain to deduplicated dimension and fact tables and audited states.

    Files are parsed once and kept as a written table; facts keep one row per point over all domains, the best domain first.
    With ``out`` every table is exported as Parquet.
    """
    scans = [corpus.scan_domain(spark, root, domain) for domain, root in roots.items()]
    files = scans[0]
    for s in scans[1:]:
        files = files.unionByName(s)
    files = written(files, "scan")
    priority = clean.domain_priority(F.col("source_domain"))
    order = [priority, "source_file", "position"]
    points = corpus.measurements(files).withColumns({"x_raw": F.col("x"), "y_raw": F.col("y"), "x_si": F.col("x"), "y_si": F.col("y")}).drop("x", "y")
    facts = clean.cross_domain_dedup(points, ("source_file", "position"))
    tables = {
        "dim_properties": corpus.properties(files),
        "dim_papers": clean.keep_first(corpus.papers(files), ["paper_id"], order),
        "dim_samples": clean.keep_first(corpus.samples(files), ["sample_id", "paper_id"], order),
        "dim_figures": clean.keep_first(corpus.figures(files), ["figure_id", "paper_id"], order),
        "fact_measurements": facts,
        "thermoelectric_states": states.state_table(facts.filter("property_id_x = 1")),
        "scan_summary": corpus.scan_summary(files),
    }
    if out is not None:
        writers.export_tables(tables, out)
    return tables


def publication_dataset(df: DataFrame, order: str, overrides: dict[str, str] | None = None, skip_dedup: bool = False) -> DataFrame:
    """A wide table of states as the publication dataset: resolved columns, audit, duplicate and sigma-rho bits.

    Duplicate and sigma-rho bits are added to the flags and leave the tier as it is.
    """
    paper, composition, rho = (tabular.resolve(df, q) for q in ("paper", "composition", "rho"))
    num = tabular.numeric_states(df, overrides).withColumnRenamed("zt", "zt_reported")
    key = text.row_dedup_key(F.col(paper) if paper else F.lit(None), F.col(composition) if composition else F.lit(None), F.col("t"))
    out = clean.duplicate_flags(physics.audit(num), key, [order], bypass=skip_dedup)
    out = out.withColumn("anomaly_flags", F.col("anomaly_flags").bitwiseOR(F.col("dup_flag")))
    if rho and rho in out.columns:
        out = out.withColumn("anomaly_flags", physics.sigma_rho_row_flag(F.col("anomaly_flags"), F.col("sigma"), F.col(rho).cast("string").try_cast("double")))
    return writers.publication_rows(out)


def before_and_after(points: DataFrame, tiers=(1, 2)) -> dict[str, DataFrame]:
    """Raw against clean points per property: counts, descriptions and two-sample tests, beside tier and flag tables.

    Clean points are those of samples with a state in the given tiers (a semi join, without fan-out).
    """
    table = states.state_table(points.filter("property_id_x = 1"))
    kept = states.clean_states(table, tiers).select("sample_id", "paper_id").distinct().withColumn("is_clean", F.lit(True))
    marked = points.join(kept, ["sample_id", "paper_id"], "left").withColumn("is_clean", F.coalesce("is_clean", F.lit(False)))
    main = marked.filter(F.col("property_id_y").isin(2, 3, 4, 16))
    return {
        "properties": clean.ingest_counters(points),
        "description": stats.describe(main, ["property_id_y", "is_clean"], "y_si", exact=False),
        "two_sample": stats.ks_two_sample(main, "y_si", F.col("is_clean"), ["property_id_y"]),
        "tiers": stats.tier_distribution(table),
        "flags": stats.flag_frequency(table),
        "counters": stats.pipeline_counters(table),
        "funnel": stats.funnel(table),
    }


CURVE_COLUMNS = ("temperature", "seebeck", "electrical_conductivity", "thermal_conductivity")


def record_points(curves: DataFrame, samples: DataFrame, papers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Curves joined with their provenance as one row per point, and the records whose lists are unreadable or of unequal length.

    ``curves``: sample_id and four list texts; ``samples``: sample_id, doi; ``papers``: doi, credibility_prior (0.5 if null).
    """
    provenance = samples.join(papers, "doi").select("sample_id", "doi", F.coalesce(F.col("credibility_prior").cast("double"), F.lit(0.5)).alias("credibility_prior"))
    lists = curves.join(provenance, "sample_id").withColumns({c: F.from_json(c, "array<double>") for c in CURVE_COLUMNS})
    sizes = [F.size(c) for c in CURVE_COLUMNS]
    good = physics.all_of(*(F.coalesce(s == sizes[0], F.lit(False)) & (s >= 0) for s in sizes))
    zipped = F.posexplode(F.arrays_zip(*CURVE_COLUMNS)).alias("position", "p")
    points = lists.filter(good).select("sample_id", "doi", "credibility_prior", zipped).select("sample_id", "doi", "credibility_prior", "position", *(F.col(f"p.{c}").alias(n) for c, n in zip(CURVE_COLUMNS, ("t", "s", "sigma", "kappa"), strict=True)))
    return points, lists.filter(~good).select("sample_id", F.lit("LISTS_UNEQUAL").alias("error_code"))


def score_records(points: DataFrame, record: str = "sample_id", lam: float = 0.05, strict: bool = False) -> DataFrame:
    """Per record: whether all its points pass the hard gate, how many do not, mean zT, and its quality score.

    A record is valid if every point does; uncertainties default to 5 %. ``strict`` raises at the first invalid point, as a batch
    that fails whole; by default a bad point costs its own record only.
    """
    args = [F.col(c) for c in ("s", "sigma", "kappa", "t")]
    err = physics.propagate(*args, *(physics.default_error(a) for a in args))
    code = physics.state_code(*args, F.lit(None).cast("double"))
    scored = points.withColumns({"zt": physics.zt_batch(*args), "zt_uncertainty": F.when(code.isNull(), err["zt_error"]), "code": code})
    if strict:
        scored = scored.withColumn("zt", F.when(F.col("code").isNotNull(), F.raise_error(F.concat(F.lit("invalid state: "), F.col("code"))).cast("double")).otherwise(F.col("zt")))
    passes = F.col("code").isNull() & F.col("zt").isNotNull()
    by = scored.groupBy(record).agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if(~passes).alias("n_violations"), F.bool_and(passes).alias("valid"),
        F.avg(F.when(F.col("zt") >= 0, F.col("zt"))).alias("mean_zt"), F.max("zt").alias("max_zt"), F.avg("zt_uncertainty").alias("mean_uncertainty"), F.max("credibility_prior").alias("credibility"),
    )
    share = 1 - F.col("n_violations") / F.col("n_points")
    parts = {"completeness": share, "credibility": F.coalesce("credibility", F.lit(0.5)), "physics_consistency": share, "error_magnitude": F.greatest(F.lit(0.0), 1 - F.coalesce("mean_uncertainty", F.lit(1.0))), "smoothness": F.lit(1.0), "metadata": F.lit(1.0)}
    q = quality.quality(parts, F.col("valid"), lam)
    return by.withColumns({"score": q["score"], "quality_class": q["quality_class"]})


def run_records(curves: DataFrame, samples: DataFrame, papers: DataFrame, strict: bool = False) -> PipelineResult:
    """The record pipeline from three tables to its counts."""
    points, broken = record_points(curves, samples, papers)
    one = score_records(points, strict=strict).agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("ok"), F.coalesce(F.sum("n_violations"), F.lit(0)).alias("v"), F.avg(F.when(F.col("valid"), F.col("mean_zt"))).alias("mean"), F.max(F.when(F.col("valid"), F.col("max_zt"))).alias("top")).first()
    bad = broken.count()
    return PipelineResult(one["n"] + bad, one["ok"], one["n"] - one["ok"] + bad, one["v"], one["mean"] or 0.0, one["top"] or 0.0)


def policy_table(spark: SparkSession) -> DataFrame:
    """The allowed properties with their bounds."""
    return spark.createDataFrame([(i, a, b) for i, (a, b) in K.POLICY_BOUNDS.items()], "property_id int, bound_min double, bound_max double")
