"""Mixing sources to target shares of tokens, with a cap on how often a document is used."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvinlake.llm.tokens import RANKS_PATH, count_tokens, load_encoding
from kelvinlake.session import spread, written

#: Hashed word features of the domain classifier, and its classes of length, two to each doubling.
BUCKETS, LENGTHS = 4096, 64
#: Probability that a document delivered as of a source is of that domain; what is left is spread over the other domains.
LABEL_TRUST = 0.995
#: Steps of projected gradient descent at most, and the largest residual, as a share of all tokens, at which it ends earlier.
STEPS, CLOSE_ENOUGH = 20, 1e-5
#: Residual from which a default total counts as too large to be met and is lowered.
MISSED = 2e-3
#: The default total as a part of the largest that the caps allow, where no rate could move any more.
PART_OF_LIMIT = 0.97
#: Documents of one rounding group; each group rounds its rates by systematic sampling.
ROUNDING_GROUP = 10_000
#: Labelled texts, each left out of the counts in turn, that choose the temperature of the classifier (its counts cover all texts).
TEMPERATURE_ROWS = 2_000

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    max_repeats: int


def features(text: str | None) -> np.ndarray:
    """Counts of hashed lower-case words of the whole text, and behind them a mark in its class of length."""
    out = np.zeros(BUCKETS + LENGTHS, dtype=np.float32)
    out[BUCKETS + min(LENGTHS - 1, int(2 * math.log2(len(text) + 1)) if text else 0)] = 1
    if not text:
        return out
    seen = Counter(_WORD.findall(text.lower()))
    np.add.at(out, [_bucket(w) for w in seen], list(seen.values()))
    return out


@lru_cache(maxsize=200_000)
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def _class_counts(docs: DataFrame, domains: list[str]) -> np.ndarray:
    """Features and number of texts per domain over all labelled texts; each task sends one matrix of fixed size, summed on the cluster."""
    index = {d: i for i, d in enumerate(domains)}
    width = BUCKETS + LENGTHS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(domains), width))
        for batch in batches:
            for source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                i = index.get(source)
                if i is not None:
                    total[i, :-1] += features(text)
                    total[i, -1] += 1
        d, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(b, pa.int32()), pa.array(total[d, b])], names=["d", "b", "n"])

    sums = docs.select("source", "text").mapInArrow(run, "d int, b int, n double").groupBy("d", "b").agg(F.sum("n").alias("n"))
    out = np.zeros((len(domains), width))
    for r in sums.collect():  # at most len(domains) * width numbers, whatever the input
        out[r["d"], r["b"]] = r["n"]
    return out


@dataclass
class DomainModel:
    """Classifier of domains: summed log odds of the words of whole texts, cooled by a fitted temperature, those of the length, and the label as a noisy channel."""

    domains: list[str]
    counts: np.ndarray
    trust: float = LABEL_TRUST
    temperature: float = 1.0
    length_power: float = 0.0

    @classmethod
    def fit(cls, docs: DataFrame, domains: list[str], trust: float = LABEL_TRUST) -> DomainModel:
        model = cls(domains, _class_counts(docs, domains), trust)
        rows = docs.filter(F.col("source").isin(domains)).orderBy(F.xxhash64("doc_id")).limit(TEMPERATURE_ROWS).select("source", "text").collect()
        if rows:
            x = np.stack([features(r["text"]) for r in rows])
            y = np.array([domains.index(r["source"]) for r in rows])
            odds = model.log_odds(x, y)
            grid = [(t, power) for power in (0.0, 0.5, 1.0) for t in (0.02, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0)]
            model.temperature, model.length_power = max(grid, key=lambda g: np.log(model._soften(*odds, *g)[np.arange(len(y)), y] + 1e-12).mean())
        return model

    def log_odds(self, x: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of the domains by words, summed, and by length and prior; and the number of words. A text with a label (not -1) is left out of the counts of that domain."""
        own = np.flatnonzero(labels >= 0)
        y = labels[own]

        def part(columns: slice, smooth: float) -> np.ndarray:
            seen, xs = self.counts[:, columns] + smooth, x[:, columns]
            total = seen.sum(axis=1)
            z = xs @ np.log(seen / total[:, None]).T
            if len(own):
                # Only the words a text has: what is left of their counts without it.
                mine = xs[own]
                row, column = np.nonzero(mine)
                n = mine[row, column].astype(float)
                left = np.log(np.maximum(seen[y[row], column] - n, smooth))
                sums = np.bincount(row, weights=n * left, minlength=len(own))
                whole = mine.sum(axis=1, dtype=float)
                z[own, y] = sums - whole * np.log(np.maximum(total[y] - whole, smooth))
            return z

        docs = np.tile(self.counts[:, -1] + 1.0, (len(x), 1))
        docs[own, y] = np.maximum(docs[own, y] - 1, 1.0)
        return part(slice(0, BUCKETS), 0.5), part(slice(BUCKETS, BUCKETS + LENGTHS), 0.5) + np.log(docs / docs.sum(axis=1, keepdims=True)), np.maximum(x[:, :BUCKETS].sum(axis=1), 1)

    @staticmethod
    def _soften(words: np.ndarray, rest: np.ndarray, n: np.ndarray, temperature: float, power: float) -> np.ndarray:
        z = words / (temperature * n**power)[:, None] + rest
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, texts: list[str | None], sources: list[str | None]) -> np.ndarray:
        """Probabilities of the domains for each text. A text does not count towards itself; a label counts as far as labels are trusted."""
        index = {d: i for i, d in enumerate(self.domains)}
        labels = np.array([index.get(s, -1) for s in sources])
        p = self._soften(*self.log_odds(np.stack([features(t) for t in texts]), labels), self.temperature, self.length_power)
        known = np.flatnonzero(labels >= 0)
        channel = np.full((len(known), len(self.domains)), (1 - self.trust) / max(1, len(self.domains) - 1))
        channel[np.arange(len(known)), labels[known]] = self.trust
        p[known] = p[known] * channel
        return p / p.sum(axis=1, keepdims=True)


def with_posteriors(docs: DataFrame, model: DomainModel, ranks_path: str = RANKS_PATH) -> DataFrame:
    """(doc_id, source, n_tokens, posterior) of every document, in one pass over the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_path)
        for batch in batches:
            sources, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            tokens, post = [], []
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                tokens.extend(count_tokens(encoding, t) for t in part)
                post.extend(model.posterior(part, sources[at : at + 256]).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(post, pa.list_(pa.float64()))], names=["doc_id", "source", "n_tokens", "posterior"])

    return spread(docs.select(F.col("doc_id").cast("long"), "source", "text")).mapInArrow(run, "doc_id long, source string, n_tokens long, posterior array<double>")


def _memberships(batch: pa.RecordBatch, names: list[str], caps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, soft membership, and highest rate: the cap of the source, or the expected cap where the source is unknown."""
    soft = batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(names))
    at = pa.compute.index_in(batch.column("source"), value_set=pa.array(names, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
    return batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float), soft, np.where(at >= 0, caps[at], soft @ caps)


@dataclass
class Fit:
    """What the fit came to: the total of tokens aimed at, the steps taken, and the largest residual as a share of that total, at the start and at the end."""

    total: float
    steps: int
    first_residual: float
    residual: float


def _rates(soft: np.ndarray, top: np.ndarray, start: float, history: list[np.ndarray]) -> np.ndarray:
    """Rates by replaying the projected steps, so that documents keep no state between steps."""
    rate = np.minimum(start, top)
    for step in history:
        rate = np.clip(rate + soft @ step, 0, top)
    return rate


def fit_rates(docs: DataFrame, targets: list[Target], steps: int = STEPS, total_tokens: float | None = None) -> tuple[DataFrame, Fit]:
    """Nonnegative document rates by projected-gradient least squares; adds ``rate`` to (doc_id, source, n_tokens, posterior).

    From equal rates, the squared distance between the expected token totals of the soft domains and their targets is
    minimised. A rate lies between 0 and the cap of its source. ``total_tokens`` defaults to nearly the largest total at
    which every target share can be met within the caps, and is lowered as long as the shares are missed. Each step is one aggregate over all documents: the totals and the
    Gram matrix of the memberships of rates free to move, which preconditions the gradient. A step that does not lessen
    the residual is halved; the best rates found are kept.
    """
    names = [t.source for t in targets]
    k = len(names)
    caps = np.array([float(t.max_repeats) for t in targets])
    share = np.array([t.share for t in targets])

    def sums(values, size: int) -> np.ndarray:
        """Sum over all documents of a vector of fixed size; ``values`` maps (tokens, memberships, highest rates) of a batch to it."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    out += values(*_memberships(batch, names, caps))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(out)], names=["i", "v"])

        out = np.zeros(size)
        for r in docs.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out

    seen = sums(lambda t, m, top: np.concatenate([(t * top) @ m, [t.sum()], *([(m > 0.5).T @ t])]), 2 * k + 1)
    reach, tokens, have = seen[:k], seen[k], seen[k + 1 :] > 0
    limit = np.where(have & (share > 0), reach / np.where(share > 0, share, 1), np.inf)
    total = total_tokens if total_tokens is not None else (PART_OF_LIMIT * float(limit.min()) if np.isfinite(limit).any() else 0.0)
    start = total / max(tokens, 1.0)

    def state(history: list[np.ndarray], total: float) -> tuple[np.ndarray, np.ndarray]:
        """Residuals as shares of all tokens, and the Gram matrix of the rows that may move on the same scale, both from one pass."""

        def values(t: np.ndarray, m: np.ndarray, top: np.ndarray) -> np.ndarray:
            rate = _rates(m, top, start, history)
            free, low, high = (rate > 0) & (rate < top), (rate <= 0) & (top > 0), (rate >= top) & (top > 0)
            return np.concatenate([(t * rate) @ m, *(((m[f] * t[f, None]).T @ m[f]).ravel() for f in (free, low, high))])

        out = sums(values, k + 3 * k * k)
        scale = np.where(have, 1.0 / max(total, 1.0), 0.0)  # a domain that no document belongs to has no residual
        residual = (out[:k] - share * total) * scale
        gram, low, high = out[k:].reshape(3, k, k)
        # Rows at the upper edge can only move down, which domains with too much ask of them, and rows at the lower edge only up.
        much = (residual > 0).astype(float)
        return residual, (gram + high * np.outer(much, much) + low * np.outer(1 - much, 1 - much)) * np.outer(scale, scale)

    def descend(total: float) -> tuple[list[np.ndarray], Fit]:
        history: list[np.ndarray] = []
        residual, gram = state(history, total)
        first = worst = float(np.abs(residual).max(initial=0.0))
        best, taken, factor = float(residual @ residual), 0, 1.0
        while taken < steps and worst > CLOSE_ENOUGH:
            taken += 1
            ridge = 1e-6 * max(float(np.trace(gram)), 1e-300) / k
            step = -np.where(have, 1.0 / max(total, 1.0), 0.0) * np.linalg.solve(gram + ridge * np.eye(k), residual) * factor
            trial, trial_gram = state([*history, step], total)
            if trial @ trial < best * 0.98:
                history.append(step)
                residual, gram, best, factor = trial, trial_gram, float(trial @ trial), min(1.0, 2 * factor)
                worst = float(np.abs(residual).max())
            elif factor < 0.2:
                break
            else:
                factor /= 2
        return history, Fit(total, taken, first, worst)

    history, fit = descend(total)
    while total_tokens is None and steps and fit.residual > MISSED and fit.total > 0.1 * total:
        history, fit = descend(0.9 * fit.total)  # the domains want the same documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, soft, top = _memberships(batch, names, caps)
                rate = _rates(soft, top, start, history)
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "source", "n_tokens", "posterior")] + [pa.array(rate)], names=["doc_id", "source", "n_tokens", "posterior", "rate"])

    return docs.mapInArrow(run, "doc_id long, source string, n_tokens long, posterior array<double>, rate double"), fit


def round_rates(rated: DataFrame, group_docs: int = ROUNDING_GROUP) -> DataFrame:
    """Whole repeats whose sum follows the rates: systematic sampling along length inside bounded groups.

    A document's repeats are its rate rounded up or down, hence never above its cap. Groups are parts of a source by a
    random hash, so a source that holds most documents is spread over many tasks.
    """
    n = rated.count()
    parts = max(1, -(-n // group_docs))
    group = rated.withColumn("__part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    along = Window.partitionBy("source", "__part").orderBy("n_tokens", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    cumulated = F.sum(F.round("rate", 9)).over(along)
    offset = F.pmod(F.xxhash64("source", "__part"), F.lit(1000)) / 1000
    upto = group.withColumn("__sum", F.round(cumulated, 6)).withColumn("__offset", offset)
    taken = F.floor(F.col("__sum") + F.col("__offset")) - F.floor(F.round(F.col("__sum") - F.round("rate", 9), 6) + F.col("__offset"))
    capped = F.greatest(F.floor(F.round("rate", 6)), F.least(F.ceil(F.round("rate", 6)), taken))
    return upto.withColumn("repeats", capped.cast("int")).drop("__part", "__sum", "__offset")


def mix(documents: DataFrame, targets: list[Target], steps: int = STEPS, total_tokens: float | None = None, ranks_path: str = RANKS_PATH, trust: float = LABEL_TRUST) -> DataFrame:
    """How often each document is used: (doc_id, source, n_tokens, posterior, rate, repeats), one row per input row.

    Method: a classifier trained on the labelled documents predicts domain posteriors, each text left out of its own
    prediction; distributed projected-gradient least squares fits document rates whose expected domain totals match the
    targets (:func:`fit_rates`); rates are rounded to whole repeats (:func:`round_rates`). Documents without tokens are
    used 0 times; a source that is null or not among the targets takes part by its posterior; a target whose source has
    no document gets nothing.
    """
    docs = documents.select("doc_id", "source", "text")
    model = DomainModel.fit(docs, [t.source for t in targets], trust)
    scored = written(with_posteriors(docs, model, ranks_path), "posteriors")
    rated, _ = fit_rates(scored, targets, steps, total_tokens)
    rounded = round_rates(written(rated, "rates"))
    return rounded.withColumn("repeats", F.when(F.col("n_tokens") > 0, F.col("repeats")).otherwise(0)).select("doc_id", "source", "n_tokens", "posterior", "rate", "repeats")


def shares(mixed: DataFrame, targets: list[Target]) -> DataFrame:
    """Per source: documents, tokens there are, tokens used, target share, share reached by label, and share reached by soft domains.

    Sources that are no target have neither a target nor a soft share.
    """
    goal = F.create_map(*(F.lit(x) for t in targets for x in (t.source, t.share)))[F.col("source")]
    used = F.col("n_tokens") * F.col("repeats")
    by = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens_available"), F.sum(used).alias("tokens_used"), F.max("repeats").alias("most_repeats"))
    soft = mixed.agg(F.array(*(F.sum(used * F.col("posterior")[i]) for i in range(len(targets)))).alias("s"), F.sum(used).alias("all"))
    names = F.array(*(F.lit(t.source) for t in targets))
    soft = soft.select("all", F.explode(F.arrays_zip(names.alias("name"), F.col("s").alias("s"))).alias("z")).select(F.col("z.name").alias("source"), F.try_divide("z.s", F.col("all").cast("double")).alias("soft_share"))
    whole = F.sum("tokens_used").over(Window.partitionBy())
    return by.join(soft, "source", "left").select(
        "source", goal.alias("target_share"), "n_docs", "tokens_available", "tokens_used", "most_repeats", F.try_divide(F.col("tokens_used").cast("double"), whole).alias("actual_share"), "soft_share"
    )
