"""Nearest-time pairing, packing and mixing against brute force and their own bounds; moderation on held-out texts."""

import math
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kelvinlake.llm import mixing, moderation, nearest, packing, queries, tokens

NAN, INF = float("nan"), float("inf")


# ---- nearest in time ------------------------------------------------------------------------------------------------


def brute_nearest(left, right, tolerance):
    out = Counter()
    for k, t, i in left:
        if k is None or t is None or not math.isfinite(t):
            continue
        c = [(abs(t - u), u, j) for h, u, j in right if h == k and u is not None and math.isfinite(u) and abs(t - u) <= tolerance]
        if c:
            out[(i, min(c)[2])] += 1
    return out


number = st.one_of(st.none(), st.sampled_from([NAN, INF]), st.integers(-60, 60).map(lambda v: v / 4))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), number), max_size=30), st.lists(st.tuples(st.sampled_from([1, 2, None]), number), max_size=30))
def test_nearest_equals_brute_force(spark, left, right):
    left = [(k, t, i) for i, (k, t) in enumerate(left)] + [(1, 0.5, 999)] * 2
    right = [(k, t, i) for i, (k, t) in enumerate(right)]
    l, r = (spark.createDataFrame(x, "k int, t double, id long") for x in (left, right))  # noqa: E741
    for rows in (200_000, 3):  # 3: every group is hot and is split
        out = nearest.nearest_pairs(l, r.withColumn("left_id", F.lit("clash")), ["k"], "t", "t", "id", "id", 2.0, band=5.0, group_rows=rows)
        assert Counter((x["left_id"], x["right_id"]) for x in out.collect()) == brute_nearest(left, right, 2.0)


def test_p2_agrees_with_sql(spark, sf_dir):
    con = duckdb.connect()
    for n in ("fact_measurements", "interpolated_states"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{sf_dir}/{n}.parquet'")
    expected = Counter(con.execute(queries.ORACLE["p2_found"]).fetchall())
    assert expected and Counter(tuple(r) for r in queries.p2_found(spark, sf_dir).collect()) == expected


# ---- tokens and packing ---------------------------------------------------------------------------------------------


@cache
def load():
    return tokens.load_encoding()


def test_token_counts(spark):
    long = "Wärmeleitfähigkeit of the sample " * 20_000
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "Hello world"), (5, long), (6, "a" * 300_000)], "id long, text string")
    got = {r["id"]: r["n_tokens"] for r in tokens.token_counts(df, "text", ["id"]).collect()}
    enc = tokens.load_encoding()
    assert (got[1], got[2], got[3], got[4]) == (0, 0, 1, 2)
    assert got[5] == len(enc.encode_ordinary(long)) and got[6] == len(enc.encode_ordinary("a" * 300_000))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 .'\n\tsé漢", max_size=60))
def test_cuts_change_no_token(text):
    enc = load()
    whole = len(enc.encode_ordinary(text))
    for m in tokens._CUT.finditer(text):
        assert len(enc.encode_ordinary(text[: m.start()])) + len(enc.encode_ordinary(text[m.start() :])) == whole


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_pack_is_a_partition_and_never_worse(sizes):
    start, bins = packing.pack(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= len(start) and start == packing.initial_bins(sizes, 100)


def test_local_search_empties_bins():
    sizes = [51, 27, 26, 23, 23, 24, 50, 26, 50]
    loose = [[i] for i in range(len(sizes))]
    better = packing.improve(sizes, loose, 100)
    assert len(better) <= math.ceil(sum(sizes) / 100) + 1
    rng = np.random.default_rng(3)
    sizes = rng.integers(20, 70, 400).tolist()
    start, end = packing.pack(sizes, 100)
    assert len(end) < len(start)
    swap = packing.improve([60, 35, 55, 40], [[0, 1], [2, 3]], 100)
    assert sorted(i for b in swap for i in b) == [0, 1, 2, 3]


def test_pack_documents(spark):
    rng = np.random.default_rng(5)
    counts = spark.createDataFrame([(i, int(n)) for i, n in enumerate([0, 512, 513, 5000, *rng.integers(1, 600, 3000)])], "doc_id long, n_tokens long")
    kinds = [("short", 512), ("long", 8192)]
    packed = packing.pack_documents(counts, kinds, group_containers=100, group_pieces=500)
    for kind, capacity in kinds:
        rows = packed.filter(F.col("pack_kind") == kind).collect()
        fill, docs, pieces = Counter(), Counter(), defaultdict(list)
        for r in rows:
            fill[r["container"]] += r["n_tokens"]
            docs[r["doc_id"]] += r["n_tokens"]
            pieces[r["doc_id"]].append((r["from_token"], r["n_tokens"]))
        assert max(fill.values()) <= capacity
        want = {r["doc_id"]: r["n_tokens"] for r in counts.filter("n_tokens > 0").collect()}
        assert dict(docs) == want
        assert all(len(p) == math.ceil(want[d] / capacity) for d, p in pieces.items())
    report = {r["pack_kind"]: r for r in packing.packing_report(packed, kinds).collect()}
    assert report["long"]["share_used"] > 0.93 and report["short"]["largest_fill"] <= 512
    assert packing.pack_documents(counts.limit(0), kinds).count() == 0


# ---- mixing ---------------------------------------------------------------------------------------------------------


def documents(spark, n=600):
    words = {"alloys": "melt ingot phase grain alloy", "code": "return value loop class int", "prose": "the river went slowly home again"}
    rows = [(i, s, " ".join([words[s]] * (1 + i % 7))) for i, s in enumerate(["alloys"] * (n // 2) + ["code"] * (n // 3) + ["prose"] * (n // 6))]
    rows += [(n, None, "the river went slowly"), (n + 1, "alloys", None), (n + 2, "other", ""), (n + 3, "code", " ")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_mixture_meets_targets(spark):
    targets = [mixing.Target("alloys", 0.3, 1), mixing.Target("code", 0.4, 2), mixing.Target("prose", 0.3, 3)]
    mixed = mixing.mix(documents(spark), targets).cache()
    assert mixed.count() == 604
    cap = {t.source: t.max_repeats for t in targets} | {None: 3, "other": 3}
    assert all(0 <= r["repeats"] <= cap[r["source"]] and 0 <= r["rate"] <= cap[r["source"]] + 1e-9 for r in mixed.collect())
    for r in mixing.shares(mixed, targets).filter("target_share IS NOT NULL").collect():
        assert abs(r["actual_share"] - r["target_share"]) < 0.03, r
    mixed.unpersist()


@pytest.mark.parametrize("label", ["IF(doc_id % 2 = 0, NULL, source)", "IF(doc_id % 2 = 0, element_at(array('alloys', 'code', 'prose'), CAST(doc_id / 2 % 3 AS INT) + 1), source)"])
def test_soft_targets_hold_without_half_of_the_labels(spark, label):
    """Labels absent or wrong for half of the documents: the posteriors carry the mixture, and the fit beats equal rates."""
    targets = [mixing.Target("alloys", 0.3, 2), mixing.Target("code", 0.4, 2), mixing.Target("prose", 0.3, 3)]
    true = documents(spark).filter("doc_id < 600").withColumnRenamed("source", "domain")
    given = true.withColumn("source", F.expr(label.replace("source", "domain"))).select("doc_id", "source", "text")
    model = mixing.DomainModel.fit(given, [t.source for t in targets], trust=0.6)
    scored = mixing.with_posteriors(given, model).cache()
    rated, fit = mixing.fit_rates(scored, targets)
    assert fit.residual < 0.01 < mixing.fit_rates(scored, targets, steps=0)[1].residual
    by = {r["domain"]: r["t"] for r in rated.join(true.select("doc_id", "domain"), "doc_id").groupBy("domain").agg(F.sum(F.col("n_tokens") * F.col("rate")).alias("t")).collect()}
    total = sum(by.values())
    assert all(abs(by[t.source] / total - t.share) < 0.1 for t in targets)
    got = {r["source"]: r for r in mixing.shares(mixing.mix(given, targets, trust=0.6), targets).collect()}
    assert all(abs(got[t.source]["soft_share"] - t.share) < 0.01 for t in targets)
    scored.unpersist()


def test_posterior_leaves_its_own_text_out(spark):
    """What a model without the document says is what the model with it says of the document."""
    docs = spark.createDataFrame([(1, "a", "melt ingot"), (2, "a", "melt phase grain"), (3, "b", "loop class"), (4, "b", "loop melt")], "doc_id long, source string, text string")
    whole, rest = mixing.DomainModel.fit(docs, ["a", "b"]), mixing.DomainModel.fit(docs.filter("doc_id <> 1"), ["a", "b"])
    x = np.stack([mixing.features("melt ingot")])
    for with_label, without in zip(whole.log_odds(x, np.array([0])), rest.log_odds(x, np.array([-1])), strict=True):
        assert np.allclose(with_label, without, atol=1e-6)


def test_mixture_without_a_source_and_empty(spark):
    targets = [mixing.Target("alloys", 0.5, 1), mixing.Target("missing", 0.5, 1)]
    assert mixing.mix(documents(spark, 60), targets).count() == 64
    assert mixing.mix(documents(spark).limit(0), targets).count() == 0


def test_rounding_follows_rates(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a', 'b') AS source", "1 + id % 50 AS n_tokens", "IF(id % 3 = 0, 0.37D, 1.5D) AS rate")
    out = mixing.round_rates(df, group_docs=500).groupBy("source").agg(F.sum("rate"), F.sum("repeats"), F.min("repeats"), F.max("repeats")).collect()
    for source, want, got, least, most in out:
        assert abs(want - got) < 15 and (least, most) == ((0, 1) if source == "a" else (1, 2))


# ---- moderation -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def moderator(spark, sf_dir):
    return moderation.Moderator.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/moderation_examples.parquet"))


@pytest.mark.parametrize(
    ("noisy", "plain"),
    [("di$gu57!ng", "disgusting"), ("m**n*ng", "moaning"), ("i-d-i-o-t", "idiot"), ("moronnn", "moron"), ("assholle", "asshole"), ("pr1ck", "prick"), ("imb​ecile", "imbecile"), ("brаіnlеss", "brainless"), ("f*ck*ng", "fucking"), ("s-h-o-r-t", "short"), ("s h i f t", "shift"), ("B1TCH", "bitch"), ("SH1T", "shit"), ("5hit", "shit"), ("f- u- c- k", "fuck"), ("useful", "useful"), ("12mm", "12mm"), ("CoSb3", "cosb3"), ("Mg3Sb2", "mg3sb2"), ("K-6470", "k-6470"), ("3-omega", "3-omega")],
)
def test_restoring(moderator, noisy, plain):
    assert moderator.chars.restore(moderation.fold(noisy)) == plain


@pytest.mark.parametrize(
    "text",
    [
        "You are a worthless moron.", "What a b-r-a-i-n-l-e-s-s 1d10t you are, Anna.", "> Kim wrote: \"Kill yourself, nobody will miss you.\"", "#YouAreAUselessMoron", "Women are vermin and should be driven out.",
        "Halt die Fresse, du Arschloch.", "Ferme ta gueule, espèce d'abruti.", "Cállate, hijo de puta.", "Send me nuuude pics, I am so h0rny.", "So ein dÃ¤mlicher Wichser gehÃ¶rt nicht ans GerÃ¤t.",
        "<p>Fuck <b>off</b>, Kim.</p>", "I will break\nyour fingers, Kim.", "S U C K my c0ck.",
    ],
)
def test_found(moderator, text):
    assert max(moderator.judge(p)[0] for p in moderation.passages(text)) >= moderation.THRESHOLD


@pytest.mark.parametrize(
    "text",
    [
        "Fuck, the crucible leaked again.", "I was an idiot and forgot to log the pressure.", "This bloody thermocouple is a piece of crap.", "Use the idiot-proof holder.", "A bastard-cut file was used.",
        "Women and men of the team measured together.", "I strongly disagree; the analysis is wrong.", "We stripped the electrode and exposed a naked surface.", "Penetration depth and hardness were read.",
        "The plate reads s h i f t - 18, not s-h-o-r-t.", "One comment was removed for abusive language.", "The master and slave controllers disagree.", "", " ", "?!", "K-1 4 5",
    ],
)
def test_not_found(moderator, text):
    assert max((moderator.judge(p)[0] for p in moderation.passages(text)), default=0) < moderation.THRESHOLD


def test_held_out_accuracy(spark, sf_dir):
    """Fitted without every third example, the examples left out are still told apart."""
    docs, ex = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "moderation_examples"))
    m = moderation.Moderator.fit(docs, ex.filter("example_id % 3 <> 0"))
    held = ex.filter("example_id % 3 = 0").collect()
    good = sum((max((m.judge(p)[0] for p in moderation.passages(r["snippet"])), default=0) >= moderation.THRESHOLD) == (r["label"] != "none") for r in held)
    assert good / len(held) >= 0.93  # a few labels are wrong


def test_scores_and_rates(spark, moderator):
    df = spark.createDataFrame([(1, "a", "You are a moron."), (2, "a", None), (3, "b", ""), (4, "b", "The sample was sintered. " * 20_000 + "Fuck off, Kim."), (1, "a", "You are a moron.")], "doc_id long, source string, text string")
    scores = moderation.score_documents(df.withColumn("score", F.lit("clash")), moderator)
    got = sorted((r["doc_id"], r["score"] >= moderation.THRESHOLD, r["category"]) for r in scores.collect())
    assert got == [(1, True, "abusive"), (1, True, "abusive"), (2, False, "none"), (3, False, "none"), (4, True, "abusive")]
    assert {r["source"]: (r["n_docs"], r["n_cases"]) for r in moderation.rates(scores).collect()} == {"a": (3, 2), "b": (2, 1)}
    assert moderation.score_documents(df.limit(0), moderator).count() == 0


def judged(moderator, name):
    rows = [line.split("\t") for line in (Path(__file__).parent / name).read_text().splitlines()]
    return [(label != "none", max(moderator.judge(p)[0] for p in moderation.passages(text)) >= moderation.THRESHOLD) for label, text in rows]


def figures(hits):
    right = sum(case and hit for case, hit in hits)
    return right / sum(case for case, _ in hits), right / sum(hit for _, hit in hits)


def test_fresh_sentences(moderator):
    """Sentences written before the scorer was; odd pairs were never looked at while it was built."""
    hits = judged(moderator, "fresh_sentences.tsv")
    for part in (hits, [h for i, h in enumerate(hits) if (i // 2) % 2]):
        recall, precision = figures(part)
        assert recall >= 0.9 and precision >= 0.9


@pytest.mark.parametrize("name", ["later_sentences.tsv", "blind_sentences.tsv"])
def test_later_sentences(moderator, name):
    """The first were written afterwards and then learned from; the others were written after that and measured once."""
    recall, precision = figures(judged(moderator, name))
    assert recall >= 0.85 and precision >= 0.9


@pytest.mark.parametrize("name", ["varied_sentences.tsv", "final_sentences.tsv"])
def test_varied_sentences(moderator, name):
    """Veiled threats, what is said of groups, and swearing at equipment in four languages; the second were measured once before anything was learned from them."""
    recall, precision = figures(judged(moderator, name))
    assert recall >= 0.75 and precision >= 0.9


@pytest.mark.parametrize(
    "text",
    [
        "Ce foutu tube est encore tombé en panne.", "Cette maudite pompe fuit.", "Der verdammte Ofen ist wieder kaputt.", "El maldito horno falló otra vez.", "This bloody pump failed again.",
        "The coats are too large for many black, Asian and disabled colleagues alike.", "Muslims, Christians and Jews of the group changed shifts.",
    ],
)
def test_harmless_uses_score_far_below(moderator, text):
    """A margin, as scores move with the documents that the model is fitted on."""
    assert max(moderator.judge(p)[0] for p in moderation.passages(text)) < 0.3


@pytest.mark.parametrize(("noisy", "plain"), [("masturbb@ting", "masturbating"), ("sh*th**d", "shithead"), ("ext*rm*n*ted", "exterminated"), ("fuckng", "fucking"), ("crminals", "criminals")])
def test_restoring_inflected_words(moderator, noisy, plain):
    assert moderator.chars.restore(noisy) == plain


def test_decoding_is_exact(moderator):
    """Viterbi against all strings the lattice allows, and tokens longer than any bound."""
    chars = moderator.chars
    log = chars.log_next()
    for token in ("m*r", "a5", "x**", "1d10t", "b!t"):
        lattice = chars.lattice(token)
        paths = {("", 0.0)}
        for options, drop in lattice:
            paths = {(t + x, c - cost) for t, c in paths for x, cost in options} | {(t, c - cost - moderation.REPEAT_COST) for t, c in paths for x, cost in options if t[-1:] == x} | ({(t, c - drop) for t, c in paths} if drop is not None else set())
        best = max(c + chars.log_word(t) for t, c in paths if t)
        assert abs(chars._free(lattice)[0] - best) < 1e-9
    assert log.shape == (27**3, 27)
    long = "-".join("abcdefghij" * 12)
    assert len(chars._free(chars.lattice(long))[1]) == 120
    assert chars.restore("y-o-u " + "x" * 300_000)[:3] == "you"


def test_quiet_passages_score_as_judged(spark, sf_dir, moderator):
    """The short way for passages without evidence gives what the long way gives."""
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        for p in moderation.passages(r["text"]):
            if moderator.quiet(p):
                assert moderator.chars.restore(p) == p.lower() and moderator.scorer.score(p.lower()) == moderator.scorer.score("")


@pytest.mark.parametrize("text", ["f u c k", "so f- u- c- k it", "s -h -i -t", "x i d i o t.", "(m o r o n)"])
def test_spread_letters_are_not_quiet(moderator, text):
    assert not moderator.quiet(text) and moderator.chars.restore(text) != text


def test_worst_passage_is_whole(spark, moderator):
    text = "You are a worthless moron " + "and everybody here knows it " * 60 + "at last."
    row = moderation.score_documents(spark.createDataFrame([(1, "a", text)], "doc_id long, source string, text string"), moderator).first()
    assert row["worst"] == text and row["category"] == "abusive"


def test_reports_run(spark, sf_dir):
    assert queries.p8_shares(spark, sf_dir).count() == 9
    assert queries.p7_report(spark, sf_dir).filter("share_used > 0.8").count() == 3
    assert queries.p9_rates(spark, sf_dir).filter("n_cases > 0").count() > 0
