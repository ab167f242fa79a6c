from __future__ import annotations

import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from locusframe.config import Thresholds
from locusframe.operators import haplotypes as H


def possible_pairs(pattern: str) -> list[tuple[str, str]]:
    """Every unordered haplotype pair of a pattern, by brute force."""
    ok = set()
    for one in itertools.product("12", repeat=len(pattern)):
        for two in itertools.product("12", repeat=len(pattern)):
            copies = [(a == "2") + (b == "2") for a, b in zip(one, two)]
            if all(p == "." or int(p) == c for p, c in zip(pattern, copies)):
                ok.add(tuple(sorted(("".join(one), "".join(two)))))
    return sorted(ok)


def plain_em(counts: dict[str, int], steps: int = 5000) -> tuple[dict[str, float], float]:
    pairs = {p: possible_pairs(p) for p in counts}
    names = sorted({h for ps in pairs.values() for pair in ps for h in pair})
    f = {h: 1 / len(names) for h in names}
    total = sum(counts.values())
    for _ in range(steps):
        new, like = defaultdict(float), 0.0
        for p, n in counts.items():
            w = [f[a] * f[b] * (1 if a == b else 2) for a, b in pairs[p]]
            like += n * math.log(sum(w))
            for (a, b), x in zip(pairs[p], w):
                new[a] += n * x / sum(w)
                new[b] += n * x / sum(w)
        f = {h: new[h] / (2 * total) for h in names}
    return f, like


def sample(seed: int, founders: dict[str, float], n: int, missing: float = 0.0) -> Counter:
    rng = random.Random(seed)
    out: Counter = Counter()
    for _ in range(n):
        a, b = rng.choices(list(founders), list(founders.values()), k=2)
        g = "".join(str((x == "2") + (y == "2")) for x, y in zip(a, b))
        out["".join("." if rng.random() < missing else c for c in g)] += 1
    return out


FOUNDERS = {"1111": 0.4, "1221": 0.3, "2112": 0.2, "2222": 0.1}


def frame(spark, groups: dict[str, Counter]):
    rows = [(g, p, n) for g, c in groups.items() for p, n in c.items()]
    return spark.createDataFrame(rows, "locus string, pattern string, n long")


@pytest.mark.parametrize("pattern", ["1", "111", "0.1", "..", "2101", "1.1"])
def test_expansion_equals_brute_force(spark, pattern):
    one = frame(spark, {"L": Counter({pattern: 1})})
    got = [(r.h1, r.h2) for r in H.diplotype_expand(one, ["locus"], len(pattern)).collect()]
    assert sorted(got) == possible_pairs(pattern)


@pytest.mark.parametrize("group_rows, missing", [(500_000, 0.0), (500_000, 0.05), (0, 0.05)])
def test_em_equals_plain_em(spark, group_rows, missing):
    groups = {"A": sample(1, FOUNDERS, 400, missing), "B": sample(2, {"111": 0.5, "122": 0.3, "221": 0.2}, 300)}
    limits = Thresholds(n_try=1)
    fit = H.em_haplotypes(frame(spark, groups), ["locus"], limits, group_rows=group_rows)
    got = {(r.locus, r.hap): r.freq for r in fit.haplotypes.collect()}
    for locus, counts in groups.items():
        want, like = plain_em(counts, 500)
        for hap, value in want.items():
            assert got.get((locus, hap), 0.0) == pytest.approx(value, abs=2e-4)
        start = fit.starts.filter(F.col("locus") == locus).first()
        assert start.loglik == pytest.approx(like, abs=0.05)
    totals = fit.pairs.groupBy("locus", "pattern").agg(F.sum("post").alias("s")).collect()
    assert len(totals) == sum(len(c) for c in groups.values())
    assert all(r.s == pytest.approx(1.0) for r in totals)


def test_both_roads_agree_with_restarts(spark):
    groups = {"A": sample(5, FOUNDERS, 300, 0.02), "B": sample(6, FOUNDERS, 200)}
    limits = Thresholds(n_try=2, n_batch=4)
    # Between the two sizes: one group iterates in a task, the other on Spark.
    roads = [H.em_haplotypes(frame(spark, groups), ["locus"], limits, group_rows=k) for k in (10**6, 60, 0)]
    tables = [{(r.locus, r.hap): r.freq for r in fit.haplotypes.collect()} for fit in roads]
    for other in tables[1:]:
        for key in set(tables[0]) | set(other):
            assert other.get(key, 0.0) == pytest.approx(tables[0].get(key, 0.0), abs=1e-5)


def test_too_many_haplotypes_fail(spark):
    groups = {"A": Counter({"1111": 3, "1011": 2})}
    for group_rows in (10**6, 0):
        with pytest.raises(Exception, match="candidate haplotypes"):
            H.em_haplotypes(frame(spark, groups), ["locus"], Thresholds(max_haps=3, n_batch=4), group_rows=group_rows)


def test_both_ways_stop_alike(spark):
    """Groups in one task and groups on Spark: the same pairs, to 1e-10."""
    groups = {"A": sample(5, FOUNDERS, 120, missing=0.12), "B": sample(6, FOUNDERS, 80, missing=0.05)}
    found = []
    for group_rows in (10**6, 0):
        fit = H.em_haplotypes(frame(spark, groups), ["locus"], Thresholds(n_try=2, n_batch=2), group_rows=group_rows)
        pairs = {(r.locus, r.pattern, *sorted((r.h1, r.h2))): r.post for r in fit.pairs.collect()}
        attempts = {(r.locus, r.attempt): (r.loglik, r.chosen) for r in fit.starts.collect()}
        found.append((pairs, attempts))
    (pairs, attempts), (other_pairs, other_attempts) = found
    assert pairs.keys() == other_pairs.keys()
    assert pairs == pytest.approx(other_pairs, abs=1e-10)
    for key, (loglik, chosen) in attempts.items():
        assert other_attempts[key] == (pytest.approx(loglik, abs=1e-7), chosen)


def test_no_pattern_loses_all_its_pairs(spark):
    """Ten missing sites over many even haplotypes: every pair is unlikely."""
    rng = random.Random(3)
    rows = ["".join(rng.choice("02") for _ in range(6)) for _ in range(64)]
    groups = {"A": Counter([*rows, *["......"] * 7])}
    for group_rows in (10**6, 0):
        limits = Thresholds(n_try=1, n_batch=6, min_pp=0.2)
        fit = H.em_haplotypes(frame(spark, groups), ["locus"], limits, group_rows=group_rows)
        kept = fit.pairs.groupBy("pattern").agg(F.first("n").alias("n"), F.sum("post").alias("post")).collect()
        assert sum(r.n for r in kept) == 71
        assert all(r.post == pytest.approx(1) for r in kept)


def test_founders_are_recovered(spark):
    """Acceptance values of the driver's customers at sf0.01."""
    from checks.q_haplotypes import Q

    rows = Q["em_haplotype_freq"](spark, "/root/testdata/sf0.01").filter("locus = 'LOCUS_A'").collect()
    want = {0: 0.37933, 21: 0.23233, 42: 0.19433, 112: 0.12667, 147: 0.06733}
    text = {"".join("2" if b >> k & 1 else "1" for k in range(8)): f for b, f in want.items()}
    assert {r.hap: r.freq for r in rows} == pytest.approx(text)


def test_pooling_terms_and_table(spark):
    rows = [("L", "11", 0.5), ("L", "12", 0.3), ("L", "21", 0.15), ("L", "22", 0.05), ("M", "1", 0.5), ("M", "2", 0.5)]
    haps = spark.createDataFrame(rows, "locus string, hap string, freq double")
    pooled = H.pool_and_base(haps, ["locus"], 0.2)
    got = {(r.locus, r.hap): (r.kind, r.label) for r in pooled.collect()}
    assert got == {
        ("L", "11"): ("base", "Ref."), ("L", "12"): ("haplotype", "H002"), ("L", "21"): ("rare", "Hrare"),
        ("L", "22"): ("rare", "Hrare"), ("M", "1"): ("base", "Ref."), ("M", "2"): ("haplotype", "H002"),
    }
    terms = {(r.locus, r.term): r.position for r in H.haplotype_terms(pooled, ["locus"]).collect()}
    assert terms == {("L", "haplo_genotype.2"): 1, ("L", "haplo_genotype.rare"): 2, ("M", "haplo_genotype.2"): 1}
    table = [(r.haplotype, r.alleles, round(r.hap_freq, 3)) for r in
             H.haplotype_table(pooled, ["locus"]).filter("locus = 'L'").orderBy("hap_pos").collect()]
    assert table == [("H002", "12", 0.3), ("Hrare", "**", 0.2), ("Ref.", "11", 0.5)]
