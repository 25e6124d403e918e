"""The models' mathematics by brute force: densities, likelihoods and determinants written out with arrays."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.llm import quality_classifier, quality_rules, toxicity
from thalweg.llm.common import written


def test_discriminant_by_densities(spark):
    """Scores against normal log densities from determinants and solved systems."""
    rng = np.random.default_rng(1)
    p = len(quality_classifier.X)
    clouds = [rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) * 0.2 + rng.normal(size=p) for n in (40, 9)]
    rows = [(*map(float, x), c) for c, cloud in enumerate(clouds) for x in cloud]
    df = written(spark.createDataFrame(rows, ", ".join(f"{x} double" for x in quality_classifier.X) + ", label int"))
    how = quality_classifier.Shrinkage(pooled=0.1, floor=0.03, temper=2.0)
    model = quality_classifier.fit(df, "label", how)
    got = df.select(*quality_classifier.X, quality_classifier.score(model).alias("s")).collect()
    own = [np.cov(c.T, bias=True) for c in clouds]
    sizes = [len(c) for c in clouds]
    pooled = sum(n * s for n, s in zip(sizes, own, strict=True)) / sum(sizes)

    def log_density(c, x):
        lean = sizes[c] / (sizes[c] + p)
        share = 0.1 * lean + 1 - lean
        cov = (1 - share) * own[c] + share * pooled + 0.03**2 * np.eye(p)
        off = x - clouds[c].mean(axis=0)
        return math.log((sizes[c] + 1) / (sum(sizes) + 2)) - np.linalg.slogdet(cov)[1] / 2 - off @ np.linalg.solve(cov, off) / 2

    for r in got:
        x = np.array(r[:p])
        odds = (log_density(1, x) - log_density(0, x)) / 2.0
        assert r.s == pytest.approx(1 / (1 + math.exp(-max(-500, min(500, odds)))), abs=1e-9)


def test_discriminant_of_ties_and_one_class(spark):
    names = ", ".join(f"{x} double" for x in quality_classifier.X) + ", label int"
    same = spark.createDataFrame([(*[0.5] * len(quality_classifier.X), c) for c in (0, 0, 1, 1)], names)
    model = quality_classifier.fit(same, "label")
    assert {r.s for r in same.select(quality_classifier.score(model).alias("s")).collect()} == {0.5}
    alone = quality_classifier.fit(same.where("label = 1"), "label")
    assert same.select(quality_classifier.score(alone).alias("s")).first().s > 0.5


def _likelihood(theta, y, plain, spans, ridge):
    """Mean noisy-or log likelihood with a ridge, a document at a time."""
    w, b, total = theta[:-1], theta[-1], 0.0
    for label, n, doc in zip(y, plain, spans, strict=True):
        chance = lambda z: 1 / (1 + math.exp(-z))
        none = n * math.log(1 - chance(b)) + sum(math.log(1 - chance(b + sum(w[i] for i in s))) for s in doc)
        total += math.log(1 - math.exp(none)) if label else none
    return total / len(y) - ridge / 2 * float(np.sum(w**2))


def test_training_ends_where_the_likelihood_is_flat():
    rng = random.Random(6)
    spans = [[sorted(rng.sample(range(4), rng.randint(1, 2))) for _ in range(rng.randint(0, 3))] for _ in range(60)]
    plain = [rng.randint(1, 4) for _ in spans]  # every text has a sentence
    y = [int(any(2 in s for s in doc) and rng.random() < 0.9 or rng.random() < 0.1) for doc in spans]
    owner = np.array([i for i, d in enumerate(spans) for _ in d], np.int64)
    every = [s for d in spans for s in d]
    row = np.array([i for i, s in enumerate(every) for _ in s], np.int64)
    col = np.array([k for s in every for k in s], np.int64)
    how = toxicity.Learning(rounds=4000, ridge=1e-2)
    weights, bias = toxicity._train(np.array(y, float), np.array(plain, float), owner, row, col, len(every), 4, how)
    theta, at = np.append(weights, bias), 1e-5
    for k in range(5):
        step = np.eye(5)[k] * at
        slope = (_likelihood(theta + step, y, plain, spans, 1e-2) - _likelihood(theta - step, y, plain, spans, 1e-2)) / (2 * at)
        assert abs(slope) < 2e-3


def test_scores_are_the_noisy_or_of_sentences(spark):
    parts = (" zork", "mkle ", "grum", "ork")
    model = toxicity.Model(parts, (2.5, 1.0, 3.0, 0.5), -4.0)
    texts = ["", None, "plain. words!", "a zork here. grumkle? fine\nzork grum", "ZORKgrumkle" * 3, "é zork.é grumkle é" * 20, "x. " * 500 + "grum", ".!?\n", "zork " * 4000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score(df, model).collect():
        text = texts[r.doc_id] or ""
        low, ends = toxicity.normal(text), [i for i, c in enumerate(text) if c in ".!?\n"]
        seen = [set() for _ in range(len(ends) + 1)]
        for k, part in enumerate(parts):
            for i in range(len(low) - len(part) + 1):
                if low.startswith(part, i):
                    middle = i + len(part) - 1 - len(part) // 2 - 1
                    seen[sum(e < middle for e in ends)].add(k)
        none = 1.0
        for s in seen:
            none *= 1 - 1 / (1 + math.exp(4.0 - sum(model.weights[k] for k in s)))
        assert r.score == pytest.approx(1 - none, abs=1e-12)
        assert all(0 <= s.start <= s.end <= len(text) and s.probability >= 0.5 for s in r.offending)


def test_least_determinant_of_all_subsets(spark):
    """A small group with outliers: the estimate is that of the subset of the least determinant."""
    rng = np.random.default_rng(3)
    z = quality_rules.Z
    spread = np.array([0.3, 0.2, 0.25, 0.2, 0.3])
    points = np.vstack([rng.normal(size=(11, 5)) * spread + 1.0, rng.normal(size=(3, 5)) * 0.1 + 6.0])
    df = spark.createDataFrame([("s", *map(float, x)) for x in points], "stratum string, " + ", ".join(f"{c} double" for c in z))
    got = quality_rules.robust_estimates(df, quality_rules.Rules(), True).first()
    floors = np.diag([quality_rules.FLOORS[c] ** 2 for c in z])
    cov = lambda rows: np.cov(points[list(rows)].T, bias=True)
    best = min(itertools.combinations(range(14), 11), key=lambda rows: np.linalg.slogdet(cov(rows) + floors)[1])
    assert set(best) == set(range(11))
    assert [got[f"m_{c}"] for c in z] == pytest.approx(points[list(best)].mean(axis=0).tolist())
    factor = np.array([[got[f"l_{a}_{b}"] if j <= i else 0.0 for j, b in enumerate(z)] for i, a in enumerate(z)])
    scale = quality_rules.consistency(0.75, 5)
    assert np.allclose(factor @ factor.T, scale * cov(best) + floors, rtol=1e-9)
