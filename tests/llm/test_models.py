"""Learned operators against plain decoders and scorers over the same model, and the pipeline's defined cases."""

import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_codes, pairwise_quality, quality_rules
from tests.llm.conftest import EDGE_ROWS

SF = "/root/testdata/sf0.001"
SPACES = set(" \t\n\x0b\f\r")


def kinds(text):
    """Characters by class: lower, upper, digits, spaces, symbols, others."""
    c = Counter()
    for x in text:
        cat = unicodedata.category(x)
        c["Ll" if cat == "Ll" else "Lu" if cat == "Lu" else "digit" if x in "0123456789" else "space" if x in SPACES else "symbol" if x in "#*$%&|<>" else "other"] += 1
    return [c[k] for k in ("Ll", "Lu", "digit", "space", "symbol", "other")]


def jsd(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    half = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return (half(p) + half(q)) / 2


def test_quality_verdict_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "", r["lang"]) for r in docs.collect()]
    chars, words = defaultdict(lambda: np.zeros(6)), defaultdict(Counter)
    for _, text, lang in rows:
        for group in {lang, None}:
            chars[group] += kinds(text)
            words[group].update(text.replace("\x0b", " ").encode().split())

    def reference(lang):
        total = sum(words[lang].values())
        top = sorted((-n, w) for w, n in words[lang].items() if n >= quality_rules.MIN_SHARE * total)[: quality_rules.COMMON_WORDS]
        return chars[lang] / chars[lang].sum(), [w for _, w in top], [-n / total for n, _ in top] + [1 + sum(n for n, _ in top) / total]

    refs = {lang: reference(lang) for lang in chars}
    got = {r["doc_id"]: r for r in quality_rules.rate(docs).collect()}
    verdicts = Counter()
    for i, text, lang in rows:
        ws = text.encode().split()
        shares, common, freq = refs[lang]
        r = got[i]
        near = True
        if len(ws) >= quality_rules.MIN_WORDS:
            own = [ws.count(w) / len(ws) for w in common]
            a, b = jsd(np.array(kinds(text)) / len(text), shares), jsd([*own, 1 - sum(own)], freq)
            assert math.isclose(r["class_divergence"], a, abs_tol=1e-9) and math.isclose(r["word_divergence"], b, abs_tol=1e-9)
            near = a <= quality_rules.MAX_CLASS_DIVERGENCE and b <= quality_rules.MAX_WORD_DIVERGENCE
        else:
            assert r["class_divergence"] is None and r["word_divergence"] is None
        windows = Counter(tuple(ws[j : j + 8]) for j in range(len(ws) - 7))
        covered = {j + d for j in range(len(ws) - 7) if windows[tuple(ws[j : j + 8])] > 1 for d in range(8)}
        failed = len(ws) < 20 or 100 * len(covered) > 30 * len(ws)
        assert (r["n_repeat_words"], r["base_failed"], r["kept"]) == (len(covered), failed, not failed and near)
        verdicts[failed, near] += 1
    assert len(verdicts) >= 3


def test_language_decoding_equals_a_plain_loop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_codes.fit(docs)
    texts = [r["text"] for r in docs.limit(80).collect()] + [None, "", "12 34", "é", "the und les"]
    names, scores, flags = model.predict(texts)
    for text, name, score, flag in zip(texts, names, scores, flags):
        bucket, _, letters = language_codes.grams([text or ""])
        if not letters[0]:
            assert (name, score, flag) == ("und", 0.0, False)
            continue
        margins = [sum(model.weights[b, bit] for b in bucket) / math.sqrt(len(bucket)) for bit in range(model.weights.shape[1])]
        loss = [sum(t * math.log1p(math.exp(-m * c)) for t, m, c in zip(model.trust, margins, row)) for row in model.code]
        best = min(loss)
        assert name == model.langs[loss.index(best)]
        assert math.isclose(score, 1 / sum(math.exp(best - x) for x in loss), rel_tol=1e-9)
        assert flag == (sorted(loss)[1] - best < language_codes.AMBIGUOUS)


def test_pairwise_scores_are_at_the_likelihoods_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(pairwise_quality.NAMES)))
    quality = (x[:, 0] - 0.5 * x[:, 3] + rng.normal(size=400) > 0).astype(int)
    model = pairwise_quality.fit_pairs(x, quality)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    good, bad = z[quality == 1], z[quality == 0]
    draw = np.random.default_rng(3)
    n = min(pairwise_quality.MAX_PAIRS, len(good) * len(bad))
    d = good[draw.integers(len(good), size=n)] - bad[draw.integers(len(bad), size=n)]

    def objective(w):
        return float(np.log1p(np.exp(-(d @ w))).mean() + pairwise_quality.RIDGE * (w @ w) / 2)

    least = objective(model.weights)
    assert all(objective(model.weights + step) > least for step in rng.normal(size=(200, len(model.weights))) * 0.01)
    scores = model.scores(x)
    order = np.argsort(z @ model.weights)
    assert (np.diff(scores[order]) >= 0).all() and 0 <= scores.min() and scores.max() <= 1
    cut = np.quantile(z @ model.weights, len(bad) / len(z))
    assert ((scores >= pairwise_quality.ACCEPT) == (z @ model.weights >= cut)).mean() > 0.99


def all_pairs_weights(z, quality):
    d = (z[quality == 1][:, None] - z[quality == 0][None]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(d @ w)))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + pairwise_quality.RIDGE * np.eye(len(w)), d.T @ (p - 1) / len(d) + pairwise_quality.RIDGE * w)
        w -= step / max(1.0, np.abs(step).max())
    return w


@pytest.mark.parametrize("apart", [1, 30])
def test_pairwise_fit_counts_every_pair(spark, apart):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, len(pairwise_quality.NAMES)))
    quality = (x[:, 0] - 0.5 * x[:, 3] + rng.normal(size=300) / apart > 0.4).astype(int)
    x[:, 5] *= 100
    x[7, 6] = 1000.0  # a strength far from all others
    rows = spark.createDataFrame([(int(q), r.tolist()) for q, r in zip(quality, x)], "quality int, x array<double>").repartition(5)
    model = pairwise_quality.fit_table(rows)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w = all_pairs_weights(z, quality)
    assert np.allclose(model.weights, w, atol=1e-6)
    assert math.isclose(model.cut, np.quantile(z @ w, (quality == 0).mean()), abs_tol=1e-5)


def test_pairwise_fit_uses_every_labelled_row(spark):
    n = 30_000  # more labelled rows than any earlier limit took
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("concat('a', repeat(' b1', cast(id % 7 as int)), repeat(' #', cast(id % 5 as int)))").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("cast(id % 7 + id * 7919 % 4 > 4 as int)").alias("quality"))
    model = pairwise_quality.fit(docs, labels)
    rows = [(i, "a" + " b1" * (i % 7) + " #" * (i % 5), int(i % 7 + i * 7919 % 4 > 4)) for i in range(n) if zlib.crc32(str(i).encode()) % 5]
    of = {t: pairwise_quality.features(t) for t in {t for _, t, _ in rows}}
    x = np.array([of[t] for _, t, _ in rows])
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-8) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-6), atol=1e-8)
    bad = sum(q == 0 for *_, q in rows) / len(rows)
    assert math.isclose(model.cut, np.quantile((x - model.mean) / model.scale @ model.weights, bad), abs_tol=1e-6)


def test_order_statistics_are_exact(spark):
    rng = np.random.default_rng(6)
    for values in (np.concatenate([rng.normal(size=900), [1e9, -1e9], np.full(300, 0.25)]), np.full(7, -2.5), rng.normal(size=2)):
        df = spark.createDataFrame([(float(v),) for v in values], "s double")
        for rank in {0, len(values) // 2, len(values) - 1}:
            assert pairwise_quality.order_statistic(df, rank) == np.sort(values)[rank]
        assert math.isclose(pairwise_quality.quantile(df, len(values), 0.3), np.quantile(values, 0.3))


@pytest.mark.parametrize("benchmark_rows", [0, 2])
def test_pipeline_defined_cases(spark, tmp_path, benchmark_rows):
    passage = " ".join(f"bench{i} word" for i in range(40))
    prose = [f"der und die das ist ein haus im wald nummer n{i} " * 3 + f"ende {i}" for i in range(30)]
    english = [f"the cat and the dog of the house are here with me x{i} " * 3 + f"end {i}" for i in range(30)]
    rows = [(100 + i, t, "de", "s", len(t)) for i, t in enumerate(prose)] + [(200 + i, t, "en", "s", len(t)) for i, t in enumerate(english)]
    rows += [(300, "the dog of the house " + passage, "en", "s", 1), (100, prose[0], "de", "s", len(prose[0])), (301, None, "en", None, None), (302, "", None, "s", 0)]
    rows += [(i, t, "en", "s", None) for i, t, *_ in EDGE_ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage), (2, None)][:benchmark_rows], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len(out) == len(set(out)) and not {301, 302} & set(out)
    assert (300 in out) == (benchmark_rows == 0)
    assert sum(100 <= i < 130 for i in out) >= 1 and sum(200 <= i < 230 for i in out) >= 1
    empty = tmp_path / "none"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(empty / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_both_forms_of_the_byte_pair_query_and_of_the_split_agree(monkeypatch):
    import random

    import public_tokenizers
    import regex

    from tessera.llm import byte_bpe

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    merges = byte_bpe.merge_table(ranks)
    rng = random.Random(7)
    pieces = ["".join(rng.choice("abeinorst éßñ漢😀-.0") for _ in range(rng.randrange(1, 140))) for _ in range(300)] + ["ab" * 60, "a" * 97, "a" * 96, "aab" * 33]
    got = []
    for long_piece in (0, 96, 10_000):
        monkeypatch.setattr(byte_bpe, "LONG_PIECE", long_piece)
        bpe = byte_bpe.BytePairs(ranks, merges, public_tokenizers.PATTERN)
        got.append(bpe.encode(pieces))
        bpe.close()
    assert got[0] == got[1] == got[2]
    general = regex.compile(public_tokenizers.PATTERN)
    for _ in range(400):
        text = "".join(chr(rng.randrange(256)) if rng.random() < 0.3 else rng.choice("ab 1'\n\t.ÀÿSs") for _ in range(rng.randrange(60)))
        assert bpe.split(text) == general.findall(text)
