from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.config import Thresholds
from locusframe.functions.student import two_sided_p
from locusframe.operators import glm, joint
from tests.test_haplotypes import FOUNDERS

LIMITS = Thresholds(min_freq=0.15, n_try=1)


def people(seed: int, n: int):
    """Individuals of two loci with two datasets of traits and covariates."""
    rng = random.Random(seed)
    genotypes, traits, covariates, truth = [], [], [], {}
    for i in range(n):
        iid = f"0{i}"
        for locus in ("A", "B"):
            a, b = rng.choices(list(FOUNDERS), list(FOUNDERS.values()), k=2)
            genotypes.append((locus, iid, "".join(str((x == "2") + (y == "2")) for x, y in zip(a, b))))
            truth[locus, iid] = (a, b)
        age, pc = rng.uniform(20, 80), rng.gauss(0, 0.01)
        copies = sum(h == "1221" for h in truth["A", iid])
        y = 1000 + 3 * age + 2.0 * copies + rng.gauss(0, 1)
        traits.append(("d1", iid, "t1", y))
        traits.append(("d1", iid, "t_2", rng.gauss(5, 2)))
        traits.append(("d2", iid, "t3", None if i % 5 == 0 else rng.gauss(-3, 1)))
        covariates.append((iid, age, None if i == 7 else pc))
    return genotypes, traits, covariates


@pytest.fixture(scope="module")
def fitted(spark):
    genotypes, traits, covariates = people(11, 160)
    g = spark.createDataFrame(genotypes, "locus string, iid string, pattern string")
    t = spark.createDataFrame(traits, "dataset string, iid string, trait_name string, trait double")
    c = spark.createDataFrame(covariates, "iid string, Age double, PC1 double")
    responses = glm.prepare_responses(t, c)
    fit = glm.haplotype_models(g, responses, LIMITS)
    return genotypes, traits, covariates, g, responses, fit


def rebuild(genotypes, traits, covariates, fit, locus, trait):
    """Pairs with posteriors, covariates and the trait of each individual,
    straight from the estimation result."""
    cov = {i: v for i, *v in covariates if None not in v}
    y = {i: v for _, i, name, v in traits if name == trait and v is not None}
    rows = fit.haplotypes.pairs.join(
        fit.models.filter(F.col("trait_name") == trait).select("locus", "dataset", "cohort"),
        ["locus", "dataset", "cohort"],
    ).filter(F.col("locus") == locus).collect()
    pairs = defaultdict(list)
    for r in rows:
        pairs[r.pattern].append((r.h1, r.h2, r.post))
    cohort = rows[0].cohort
    pooled = fit.pooled.filter((F.col("locus") == locus) & (F.col("cohort") == cohort)).collect()
    term = {r.hap: r.term for r in pooled}
    freq = {r.hap: r.freq for r in pooled}
    people = [(i, p) for l, i, p in genotypes if l == locus and i in cov and i in y]
    return people, pairs, term, freq, cov, y


def term_order(term):
    names = {t for t in term.values() if t not in ("haplo.base", "haplo_genotype.rare")}
    rare = ["haplo_genotype.rare"] if "haplo_genotype.rare" in term.values() else []
    return sorted(names, key=lambda t: int(t.split(".")[1])) + rare


@pytest.mark.parametrize("locus, trait", [("A", "t1"), ("B", "t_2"), ("A", "t3")])
def test_models_equal_least_squares(fitted, locus, trait):
    genotypes, traits, covariates, _, responses, fit = fitted
    people, pairs, term, _, cov, y = rebuild(genotypes, traits, covariates, fit, locus, trait)
    order = term_order(term)
    x = []
    for iid, pattern in people:
        copies = defaultdict(float)
        for h1, h2, post in pairs[pattern]:
            copies[term[h1]] += post
            copies[term[h2]] += post
        x.append([1.0, *[copies[t] for t in order], *cov[iid]])
    x, z = np.array(x), np.array([y[i] for i, _ in people])
    beta, *_ = np.linalg.lstsq(x, z, rcond=None)
    r = z - x @ beta
    df = len(z) - x.shape[1]
    se = np.sqrt(r @ r / df * np.diag(np.linalg.inv(x.T @ x)))
    got = {
        row.term: row
        for row in glm.tidy_coefficients(fit, responses.covariates)
        .filter((F.col("locus") == locus) & (F.col("trait_name") == trait)).collect()
    }
    names = ["(Intercept)", *order, "Age", "PC1"]
    assert set(got) == set(names)
    for k, name in enumerate(names):
        assert got[name].estimate == pytest.approx(beta[k], rel=1e-6, abs=1e-8)
        assert got[name].std_error == pytest.approx(se[k], rel=1e-6)
        assert got[name].df_residual == df
        p = two_sided_p(np.array([beta[k] / se[k]]), np.array([float(df)]))[0]
        assert got[name].p_value == pytest.approx(p, rel=1e-4, abs=1e-300)
    glance = glm.model_glance(fit).filter(
        (F.col("locus") == locus) & (F.col("trait_name") == trait)
    ).first()
    assert glance.deviance == pytest.approx(r @ r, rel=1e-6)
    assert glance.null_deviance == pytest.approx(((z - z.mean()) ** 2).sum(), rel=1e-8)
    assert glance.nobs == len(z)


def test_traits_with_the_same_people_share_a_cohort(fitted):
    responses = fitted[4]
    cohorts = {r.trait_name: (r.dataset, r.cohort) for r in responses.traits.collect()}
    assert cohorts["t1"] == cohorts["t_2"]
    assert cohorts["t1"][1] != cohorts["t3"][1]


def test_aliased_columns_are_left_out():
    x = np.array([[1, 1, 2.0], [1, 2, 3], [1, 5, 6], [1, 4, 5]])
    inverse, used = glm.inverse_by_sweep(x.T @ x)
    assert used.tolist() == [True, True, False]
    assert inverse[:2, :2] == pytest.approx(np.linalg.inv(x[:, :2].T @ x[:, :2]))


def test_text_covariates_are_factors(spark):
    rows = [(str(i), float(i), "FMX"[i % 3], "one") for i in range(9)] + [("9", 1.0, None, "one")]
    frame = spark.createDataFrame(rows, "iid string, Age double, Sex string, Site string")
    design, names = glm.covariate_design(frame)
    assert names == ["Age", "SexM", "SexX"]
    got = {r.iid: (r.Age, r.SexM, r.SexX) for r in design.collect()}
    assert got == {str(i): (float(i), float("FMX"[i % 3] == "M"), float("FMX"[i % 3] == "X")) for i in range(9)}
    traits = spark.createDataFrame([("d", "1", "t", 1.0)], "dataset string, iid string, trait_name string, trait double")
    with pytest.raises(ValueError, match="no individual"):
        glm.prepare_responses(traits, frame.withColumn("Sex", F.lit(None).cast("string")))


def test_no_covariates(spark):
    genotypes, traits, _ = people(3, 60)
    g = spark.createDataFrame(genotypes, "locus string, iid string, pattern string")
    t = spark.createDataFrame(traits, "dataset string, iid string, trait_name string, trait double")
    responses = glm.prepare_responses(t, None)
    fit = glm.haplotype_models(g, responses, LIMITS)
    kinds = {r.term_kind for r in glm.tidy_coefficients(fit, []).collect()}
    assert kinds <= {"intercept", "haplotype", "rare"}


def observed(theta, p, cov_rows, table, z, sigma2, ways):
    """Observed-data log likelihood at (coefficients, free frequencies)."""
    beta, free = theta[:p], theta[p:]
    f = np.append(free, 1 - free.sum())
    total = 0.0
    for c, rows, value in zip(cov_rows, table, z):
        like = 0.0
        for (h, a, b), w in zip(rows, [ways(r) for r in rows]):
            mu = np.concatenate([h, c]) @ beta
            like += w * f[a] * f[b] * np.exp(-((value - mu) ** 2) / (2 * sigma2))
        total += np.log(like)
    return total


def test_joint_fit_equals_plain_implementation(spark, fitted):
    genotypes, traits, covariates, g, responses, fit = fitted
    locus, trait = "A", "t1"
    people, pairs, term, freq, cov, y = rebuild(genotypes, traits, covariates, fit, locus, trait)
    order = term_order(term)
    haps = sorted(freq)
    means = np.array(responses.means)
    z = np.array([y[i] for i, _ in people])
    offset = z.mean()
    z = z - offset

    def part(h1, h2):
        row = np.zeros(1 + len(order))
        row[0] = 1
        for h in (h1, h2):
            if term[h] in order:
                row[1 + order.index(term[h])] += 1
        return row

    table = [[(part(a, b), haps.index(a), haps.index(b)) for a, b, _ in pairs[p]] for _, p in people]
    # Phase is ambiguous for some individuals, or this test shows nothing.
    assert sum(len(rows) > 1 for rows in table) > 10
    cs = [np.array(cov[i]) - means for i, _ in people]
    f = np.array([freq[h] for h in haps])
    p = 1 + len(order) + 2
    start = {
        r.term: r.estimate for r in glm.tidy_coefficients(fit, responses.covariates)
        .filter((F.col("locus") == locus) & (F.col("trait_name") == trait)).collect()
    }
    beta = np.array([0.0, *[start[t] for t in order], start["Age"], start["PC1"]])
    beta[0] = start["(Intercept)"] + means @ beta[-2:] - offset
    model = fit.models.filter((F.col("locus") == locus) & (F.col("trait_name") == trait)).first()
    sigma2 = model.rss / model.df_residual

    def ways(row):
        return 1.0 if row[1] == row[2] else 2.0

    for _ in range(3000):
        xx, xy, copies = np.zeros((p, p)), np.zeros(p), np.zeros(len(haps))
        for c, rows, value in zip(cs, table, z):
            xs = [np.concatenate([h, c]) for h, _, _ in rows]
            w = np.array([
                ways(r) * f[r[1]] * f[r[2]] * np.exp(-((value - x @ beta) ** 2) / (2 * sigma2))
                for r, x in zip(rows, xs)
            ])
            w /= w.sum()
            for r, x, weight in zip(rows, xs, w):
                xx += weight * np.outer(x, x)
                xy += weight * x * value
                copies[r[1]] += weight
                copies[r[2]] += weight
        new = np.linalg.solve(xx, xy)
        sigma2 = (z @ z - new @ xy) / (len(z) - p)
        f = copies / (2 * len(z))
        moved = np.abs(new - beta).max()
        beta = new
        if moved < 1e-10:
            break
    got = {
        r.term: r for r in joint.fit_joint(g, responses, fit)
        .filter((F.col("locus") == locus) & (F.col("trait_name") == trait)).collect()
    }
    names = ["(Intercept)", *order, "Age", "PC1"]
    want = beta.copy()
    want[0] = beta[0] + offset - means @ beta[-2:]
    for k, name in enumerate(names):
        assert got[name].estimate == pytest.approx(want[k], rel=1e-4, abs=1e-4)

    # Standard errors: minus the numerical Hessian of the observed likelihood.
    theta = np.concatenate([beta, f[:-1]])
    step = np.concatenate([np.full(p, 1e-3), np.full(len(f) - 1, 1e-4)])
    step[p - 1] = 1e-2
    size = len(theta)
    hessian = np.zeros((size, size))

    def value_at(i, j, di, dj):
        moved = theta.copy()
        moved[i] += di * step[i]
        moved[j] += dj * step[j]
        return observed(moved, p, cs, table, z, sigma2, ways)

    for i in range(size):
        for j in range(i, size):
            d = (value_at(i, j, 1, 1) - value_at(i, j, 1, -1) - value_at(i, j, -1, 1) + value_at(i, j, -1, -1))
            hessian[i, j] = hessian[j, i] = d / (4 * step[i] * step[j])
    se = np.sqrt(np.diag(np.linalg.inv(-hessian)))
    for k, name in enumerate(names[1:], start=1):
        assert got[name].std_error == pytest.approx(se[k], rel=2e-2)


def test_joint_fit_does_not_depend_on_blocks_or_lots(spark, fitted):
    _, _, _, g, responses, fit = fitted
    one = joint.fit_joint(g, responses, fit).collect()
    blocks = joint.subject_blocks(g, responses, fit, 3)
    assert blocks.agg(F.max("n")).first()[0] == 3
    assert blocks.agg(F.sum("n")).first()[0] == g.join(responses.rows, "iid").count()
    state, lots = joint._lots(fit.models.select(*joint.MODEL, F.col("centred").alias("beta"), F.col("centred").alias("f")), 300)
    assert lots > 2 and state.select("lot").distinct().count() > 1
    many = joint.fit_joint(g, responses, fit, block_rows=3, state_bytes=300).collect()
    key = lambda r: (r.locus, r.dataset, r.trait_name, r.term)
    other = {key(r): r for r in many}
    assert len(one) == len(many) == len(other)
    for row in one:
        assert other[key(row)].estimate == pytest.approx(row.estimate, rel=1e-7)
        assert other[key(row)].std_error == pytest.approx(row.std_error, rel=1e-6)


def test_a_round_moves_no_individuals(spark, fitted):
    _, _, _, g, responses, fit = fitted
    blocks = joint.subject_blocks(g, responses, fit)
    state = fit.models.select(*joint.MODEL, F.col("centred").alias("beta"), F.col("rss").alias("sigma2"), F.col("centred").alias("f"))
    plan = joint._with_models(blocks, state)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Sort" not in plan
    sums = joint._with_models(blocks, state).mapInPandas(joint._round_sums, f"{joint._MODEL_DDL}, sums array<double>, old array<double>")
    text = sums.groupBy(*joint.MODEL).count()._jdf.queryExecution().executedPlan().toString()
    # Between the blocks and the sums there is a broadcast only.
    below = text[text.index("MapInPandas"):]
    assert "BroadcastHashJoin" in below and "SortMergeJoin" not in below
