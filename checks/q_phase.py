"""Haplotypes of open phase with missing calls: regions are the nations, sites
come from the parts, individuals are the customers; the number of genotype
patterns grows with the tables.

Founder haplotypes are all combinations of three left and three right halves,
so individuals that differ in both halves have more than one haplotype pair.
The oracle enumerates all pairs of the 64 haplotypes of six sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import rounded
from checks.views import stored, table, with_views
from locusframe.config import Thresholds
from locusframe.operators import haplotypes, reshape
from locusframe.operators.glm import haplotype_models, prepare_responses
from locusframe.operators.joint import fit_joint
from locusframe.plans.association import long_traits
from locusframe.session import materialize, spread

Q: dict = {}
SQL: dict[str, str] = {}

_LIMITS = Thresholds(min_freq=0.01, min_pp=1e-5, n_try=1, n_batch=3)
_PAIR_SITES = (0, 4)


def query(sql: str):
    def add(fn):
        Q[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return add


def open_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six sites per region (150 rows): the parts of a nation by key modulo
    six."""
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    return (
        part.select((F.col("p_partkey") % 25).cast("int").alias("n_nationkey"), (F.col("p_partkey") % 6).alias("site"), "p_partkey")
        .join(nation.select("n_nationkey", "n_name"), "n_nationkey")
        .groupBy(F.col("n_name").alias("locus"), F.col("n_nationkey").alias("k"), "site")
        .agg(F.min("p_partkey").alias("first"), F.count("*").alias("n_parts"))
        .select("locus", "k", F.col("site").cast("int").alias("site"), (F.col("site") * 100_000_000 + F.col("first")).cast("bigint").alias("pos"))
    )


def _half(slot, codes):
    return F.when(slot < 8, codes[0]).when(slot < 13, codes[1]).otherwise(codes[2])


def open_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """locus, iid, pattern of every customer at every region."""

    def build() -> DataFrame:
        people = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), width=150)
        key, home, k = F.col("c_custkey"), F.col("c_nationkey"), F.col("k")
        # Sites 0-2 in the lower bits, 3-5 in the upper ones.
        one = _half((key * 7 + 5 * k + 3) % 16, (0, 6, 5)) + 8 * _half((F.floor(key / 16) + home + k) % 16, (0, 3, 4))
        two = _half((key * 11 + home + 3 * k) % 16, (0, 6, 5)) + 8 * _half((F.floor(key / 5) * 3 + 7 * k) % 16, (0, 3, 4))
        bit = F.pow(F.lit(2), F.col("site"))
        g = F.floor(one / bit) % 2 + F.floor(two / bit) % 2
        absent = (key + 7 * F.col("site") + k) % 29 == 0
        places = materialize(open_sites(spark, sf_dir), "open-places")
        cells = people.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(24)))).withColumn("site", F.explode(F.sequence(F.lit(0), F.lit(5))))
        rows = cells.join(F.broadcast(places), ["k", "site"]).select(
            "locus", key.cast("string").alias("iid"), F.lit("1").alias("chrom"), "pos", F.lit("A").alias("ref"), F.lit("C").alias("alt"),
            F.lit(0.5).alias("af"), F.concat(F.lit("s"), F.col("site").cast("string")).alias("snp_id"),
            F.when(~absent, g.cast("double")).alias("dosage"),
        )
        # Not stored in between: few tasks would read the packed cells again.
        sites = materialize(reshape.site_dictionary(rows.select("locus", "chrom", "pos", "ref", "alt", "snp_id").distinct()), "open-sites")
        return materialize(reshape.genotype_vectors(rows, sites), "open-vectors")

    return stored(spark, sf_dir, "open-vectors", build)


def open_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return haplotypes.genotype_patterns(open_vectors(spark, sf_dir), ["locus"])


# -- the oracle ----------------------------------------------------------------


def _half_sql(slot: str, codes: tuple[int, int, int]) -> str:
    return f"CASE WHEN {slot} < 8 THEN {codes[0]} WHEN {slot} < 13 THEN {codes[1]} ELSE {codes[2]} END"


_ONE = f"({_half_sql('(c_custkey * 7 + 5 * k + 3) % 16', (0, 6, 5))}) + 8 * ({_half_sql('(c_custkey // 16 + c_nationkey + k) % 16', (0, 3, 4))})"
_TWO = f"({_half_sql('(c_custkey * 11 + c_nationkey + 3 * k) % 16', (0, 6, 5))}) + 8 * ({_half_sql('(c_custkey // 5 * 3 + 7 * k) % 16', (0, 3, 4))})"


def _pats(sites: str, order: str) -> str:
    return f"""SELECT locus, c_custkey::VARCHAR AS iid, string_agg(CASE WHEN (c_custkey + 7 * site + k) % 29 = 0 THEN '.'
        ELSE (((one >> site) & 1) + ((two >> site) & 1))::VARCHAR END, '' ORDER BY {order}) AS pattern
      FROM (SELECT s.*, c.c_custkey, {_ONE} AS one, {_TWO} AS two FROM ({sites}) s, customer c) GROUP BY locus, c_custkey"""


_SITES_SQL = """SELECT locus, k, site, site * 100000000 + first AS pos FROM (
      SELECT n_name AS locus, n_nationkey AS k, (p_partkey % 6)::INT AS site, min(p_partkey) AS first
      FROM part JOIN nation ON p_partkey % 25 = n_nationkey GROUP BY ALL)"""

_STEPS = 80


def _expand_ctes(n_sites: int) -> list[tuple[str, str]]:
    """Every pair of haplotypes that a pattern allows (h1 <= h2 as codes)."""
    code = " || ".join(f"CAST(((h >> {i}) & 1) + 1 AS VARCHAR)" for i in range(n_sites))
    fits = " AND ".join(
        f"(p.pattern[{i + 1}] = '.' OR CAST(p.pattern[{i + 1}] AS INT) = ((a.h >> {i}) & 1) + ((b.h >> {i}) & 1))" for i in range(n_sites)
    )
    return [
        ("gp", "SELECT locus, pattern, count(*) AS n FROM pats GROUP BY locus, pattern"),
        ("hh", f"SELECT h, {code} AS code FROM (SELECT range AS h FROM range({2**n_sites}))"),
        ("allowed", f"""SELECT p.pattern, a.code AS h1, b.code AS h2, CASE WHEN a.h = b.h THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS ways
            FROM (SELECT DISTINCT pattern FROM gp) p JOIN hh a ON true JOIN hh b ON a.code <= b.code AND {fits}"""),
        ("pp", "SELECT g.locus, g.pattern, g.n, h1, h2, ways FROM gp g JOIN allowed p ON g.pattern = p.pattern"),
    ]


def _em_ctes(n_sites: int) -> list[tuple[str, str]]:
    ctes = [
        *_expand_ctes(n_sites),
        ("tot", "SELECT locus, sum(n) AS total FROM gp GROUP BY locus"),
        ("f0", "SELECT locus, h, 1.0::DOUBLE AS f FROM (SELECT locus, h1 AS h FROM pp UNION SELECT locus, h2 FROM pp)"),
    ]
    for i in range(_STEPS):
        ctes.append((f"e{i}", f"""SELECT locus, pattern, n, h1, h2, w / sum(w) OVER (PARTITION BY locus, pattern) AS post FROM (
              SELECT pp.*, a.f * b.f * ways AS w FROM pp
              JOIN f{i} a ON pp.locus = a.locus AND pp.h1 = a.h JOIN f{i} b ON pp.locus = b.locus AND pp.h2 = b.h)"""))
        ctes.append((f"f{i + 1}", f"""SELECT c.locus, c.h, sum(c.c) / (2 * any_value(t.total)) AS f FROM (
              SELECT locus, h1 AS h, n * post AS c FROM e{i} UNION ALL SELECT locus, h2, n * post FROM e{i}) c
            JOIN tot t ON c.locus = t.locus GROUP BY c.locus, c.h"""))
    return ctes


_EXPAND_SQL = with_views(extra=[("pats", _pats(_SITES_SQL, "pos")), *_expand_ctes(6)])
_EM_SQL = with_views(extra=[("pats", _pats(_SITES_SQL, "pos")), *_em_ctes(6)])
_FREQ_SQL = _EM_SQL + f"SELECT locus, h AS hap, round(f, 4) AS freq FROM f{_STEPS} WHERE f >= {_LIMITS.min_freq}"


@query(_EXPAND_SQL + "SELECT * EXCLUDE (ways) FROM pp")
def diplotype_open_phase(spark, sf_dir):
    """All haplotype pairs of every pattern, missing calls included."""
    return haplotypes.diplotype_expand(open_patterns(spark, sf_dir), ["locus"], 6)


def _common(spark, sf_dir, group_rows: int) -> DataFrame:
    fit = haplotypes.em_haplotypes(open_patterns(spark, sf_dir), ["locus"], _LIMITS, group_rows=group_rows)
    # Rarer ones are pooled by every later step.
    return rounded(fit.haplotypes.filter(F.col("freq") >= _LIMITS.min_freq), 4, "freq")


@query(_FREQ_SQL)
def em_open_phase(spark, sf_dir):
    """Groups that iterate in one task each."""
    return _common(spark, sf_dir, haplotypes.GROUP_ROWS)


@query(_FREQ_SQL)
def em_open_phase_blocks(spark, sf_dir):
    """The same estimation on blocks of patterns, as groups beyond
    ``GROUP_ROWS`` go."""
    return _common(spark, sf_dir, 0)


# -- joint fit -------------------------------------------------------------------

_JOINT_SITES = f"SELECT * FROM ({_SITES_SQL}) WHERE site IN {_PAIR_SITES}"
_HAPS = ("11", "12", "21", "22")
_TRAIT = """SELECT c_custkey::VARCHAR AS iid, c_acctbal / 1000
    + CASE WHEN (c_custkey * 7 + 3) % 16 < 8 THEN 0 WHEN (c_custkey * 7 + 3) % 16 < 13 THEN 2 ELSE -1 END AS y FROM customer"""


def _sweep(names: list[str], k: int) -> str:
    """Symmetric sweep of pivot ``k`` on the columns m_ij (i <= j)."""
    at = lambda i, j: f"m{min(i, j)}{max(i, j)}"
    size = len(_HAPS) + 1
    out = []
    for i in range(size):
        for j in range(i, size):
            if i == k and j == k:
                term = f"-1 / {at(k, k)}"
            elif i == k or j == k:
                term = f"{at(i, j)} / {at(k, k)}"
            else:
                term = f"{at(i, j)} - {at(i, k)} * {at(j, k)} / {at(k, k)}"
            out.append(f"{term} AS {at(i, j)}")
    return ", ".join([*names, *out])


def _joint_ctes() -> list[tuple[str, str]]:
    """The additive model y = m(h1) + m(h2) of the four haplotypes of two
    sites, fitted together with the phase."""
    size = len(_HAPS)
    f0 = ", ".join(f"max(CASE WHEN h = '{h}' THEN f END) AS f{i}" for i, h in enumerate(_HAPS))
    pick = lambda name, side: "CASE " + " ".join(f"WHEN r.{side} = '{h}' THEN s.{name}{i}" for i, h in enumerate(_HAPS)) + " END"
    count = [f"((h1 = '{h}')::INT + (h2 = '{h}')::INT)" for h in _HAPS]
    ctes = [
        ("trait", _TRAIT),
        ("r", "SELECT p.locus, p.iid, t.y, q.h1, q.h2, q.ways FROM pats p JOIN allowed q ON p.pattern = q.pattern JOIN trait t ON p.iid = t.iid"),
        ("freq", f"SELECT locus, {f0} FROM f{_STEPS} GROUP BY locus"),
    ]
    steps = 36
    for step in range(steps + 1):
        if step == 0:
            weight = f"ways * {pick('f', 'h1')} * {pick('f', 'h2')}"
            state = "freq"
        else:
            weight = f"ways * {pick('f', 'h1')} * {pick('f', 'h2')} * exp(-power(y - {pick('b', 'h1')} - {pick('b', 'h2')}, 2) / (2 * s.s2))"
            state = f"state{step}"
        ctes.append((f"w{step}", f"""SELECT locus, iid, y, h1, h2, w / sum(w) OVER (PARTITION BY locus, iid) AS w FROM (
            SELECT r.*, {weight} AS w FROM r JOIN {state} s ON r.locus = s.locus)"""))
        sums = [f"sum(w * {count[i]} * {count[j]}) AS m{i}{j}" for i in range(size) for j in range(i, size)]
        sums += [f"sum(w * {count[i]} * y) AS m{i}{size}" for i in range(size)] + [f"sum(w * y * y) AS m{size}{size}"]
        sums += [f"sum(w * {count[i]}) / (2 * sum(w)) AS f{i}" for i in range(size)]
        ctes.append((f"x{step}_0", f"SELECT locus, sum(w) AS n, {', '.join(sums)} FROM w{step} GROUP BY locus"))
        keep = ["locus", "n", *[f"f{i}" for i in range(size)]]
        for k in range(size):
            ctes.append((f"x{step}_{k + 1}", f"SELECT {_sweep(keep, k)} FROM x{step}_{k}"))
        betas = ", ".join(f"m{i}{size} AS b{i}" for i in range(size))
        ctes.append((f"state{step + 1}", f"SELECT {', '.join(keep)}, {betas}, m{size}{size} / (n - {size}) AS s2 FROM x{step}_{size}"))
    last = f"state{steps + 1}"
    ranked = "list_reverse_sort([" + ", ".join(f"{{'f': freq.f{i}, 'i': {i}}}" for i in range(size)) + "])[1].i"
    ctes.append(("fitted", f"SELECT s.*, {ranked} AS base, [{', '.join(f's.b{i}' for i in range(size))}] AS b FROM {last} s JOIN freq ON s.locus = freq.locus"))
    return ctes


_JOINT_SQL = with_views(extra=[("pats", _pats(_JOINT_SITES, "pos")), *_em_ctes(2), *_joint_ctes()])


@query(_JOINT_SQL + """
    SELECT locus, '(Intercept)' AS term, round(2 * b[base + 1], 4) AS estimate FROM fitted
    UNION ALL
    SELECT locus, 'haplo_genotype.' || (i + 1), round(b[i + 1] - b[base + 1], 4)
    FROM (SELECT *, unnest([0, 1, 2, 3]) AS i FROM fitted) WHERE i <> base""")
def joint_open_phase(spark, sf_dir):
    """Phase and regression fitted together where phase is open: two sites of
    each region, one trait."""
    customer = table(spark, sf_dir, "customer")
    slot = (F.col("c_custkey") * 7 + 3) % 16
    effect = F.when(slot < 8, 0).when(slot < 13, 2).otherwise(-1)
    traits = customer.select(F.col("c_custkey").cast("string").alias("iid"), (F.col("c_acctbal") / 1000 + effect).alias("balance"))
    first, second = (i + 1 for i in _PAIR_SITES)
    pattern = F.concat(F.substring("pattern", first, 1), F.substring("pattern", second, 1))
    vectors = materialize(open_vectors(spark, sf_dir).select("locus", "iid", pattern.alias("pattern")), "two-sites")
    responses = prepare_responses(long_traits({"open": traits}), None)
    fitted = fit_joint(vectors, responses, haplotype_models(vectors, responses, _LIMITS))
    return rounded(fitted.select("locus", "term", "estimate"), 4, "estimate")
