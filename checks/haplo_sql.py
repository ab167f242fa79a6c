"""Oracle SQL of the haplotype estimation and the models.

The oracle takes another road than the engine: it enumerates all pairs of
the 256 haplotypes of eight sites at once, runs a fixed number of plain EM
steps from equal frequencies, and solves the normal equations by sweeping a
table of cells.
"""

from __future__ import annotations

from checks.views import with_views

PATTERN_CTE = """
    SELECT locus, iid,
           string_agg(CAST(CAST(round_even(dosage, 0) AS INT) AS VARCHAR), '' ORDER BY pos) AS pattern
    FROM v_dosage GROUP BY locus, iid"""

_SUM = " || ".join(f"CAST(((a.h >> {k}) & 1) + ((b.h >> {k}) & 1) AS VARCHAR)" for k in range(8))
_CODES = " || ".join(f"CAST(((h >> {k}) & 1) + 1 AS VARCHAR)" for k in range(8))
_SWEEPS = 9
_Y = 99

EM_STEPS = 60


def em_ctes(source: str) -> list[tuple[str, str]]:
    """``post`` (locus, pattern, n, h1, h2, post) and ``freq`` (locus, h, f)
    for the individuals of ``source`` (locus, iid, pattern)."""
    ctes = [
        ("gp", f"SELECT locus, pattern, count(*) AS n FROM {source} GROUP BY locus, pattern"),
        ("hh", "SELECT range AS h FROM range(256)"),
        ("allpairs", f"""SELECT a.h AS h1, b.h AS h2, CASE WHEN a.h = b.h THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS ways,
            {_SUM} AS pattern FROM hh a JOIN hh b ON a.h <= b.h"""),
        ("pp", """SELECT g.locus, g.pattern, g.n, p.h1, p.h2, p.ways
            FROM gp g JOIN allpairs p ON g.pattern = p.pattern"""),
        ("tot", "SELECT locus, sum(n) AS total FROM gp GROUP BY locus"),
        ("f0", """SELECT locus, h, 1.0::DOUBLE / count(*) OVER (PARTITION BY locus) AS f FROM (
            SELECT locus, h1 AS h FROM pp UNION SELECT locus, h2 FROM pp)"""),
    ]
    for i in range(EM_STEPS):
        ctes.append((f"e{i}", f"""SELECT locus, pattern, n, h1, h2,
            w / sum(w) OVER (PARTITION BY locus, pattern) AS post FROM (
              SELECT pp.*, a.f * b.f * ways AS w FROM pp
              JOIN f{i} a ON pp.locus = a.locus AND pp.h1 = a.h
              JOIN f{i} b ON pp.locus = b.locus AND pp.h2 = b.h)"""))
        ctes.append((f"f{i + 1}", f"""SELECT c.locus, c.h, sum(c.c) / (2 * t.total) AS f FROM (
              SELECT locus, h1 AS h, n * post AS c FROM e{i}
              UNION ALL SELECT locus, h2, n * post FROM e{i}) c
            JOIN tot t ON c.locus = t.locus GROUP BY c.locus, c.h, t.total"""))
    ctes.append(("post", f"SELECT * FROM e{EM_STEPS - 1} WHERE post >= 1e-5"))
    ctes.append(("freq", f"""SELECT locus, h, {_CODES} AS hap, f FROM f{EM_STEPS}
        WHERE (locus, h) IN (SELECT (locus, h1) FROM post UNION SELECT (locus, h2) FROM post)"""))
    return ctes


POOL_CTES = [
    ("pooled", """SELECT *, CASE kind WHEN 'base' THEN 'haplo.base' WHEN 'rare' THEN 'haplo_genotype.rare'
                 ELSE 'haplo_genotype.' || hap_index END AS term,
               CASE kind WHEN 'base' THEN 'Ref.' WHEN 'rare' THEN 'Hrare'
                 ELSE 'H' || lpad(CAST(hap_index AS VARCHAR), 3, '0') END AS label
        FROM (SELECT locus, h, hap, f, row_number() OVER (PARTITION BY locus ORDER BY hap) AS hap_index,
                CASE WHEN row_number() OVER (PARTITION BY locus ORDER BY f DESC, hap) = 1 THEN 'base'
                     WHEN f < 0.1 THEN 'rare' ELSE 'haplotype' END AS kind FROM freq)"""),
    ("terms", """SELECT locus, term, label, kind,
               row_number() OVER (PARTITION BY locus ORDER BY kind = 'rare', min(hap_index)) AS position
        FROM pooled WHERE kind <> 'base' GROUP BY locus, term, label, kind"""),
    ("copies", """SELECT s.locus, s.pattern, p.term, p.label, p.kind, sum(s.post) AS copies FROM (
            SELECT locus, pattern, h1 AS h, post FROM post
            UNION ALL SELECT locus, pattern, h2, post FROM post) s
        JOIN pooled p ON s.locus = p.locus AND s.h = p.h
        GROUP BY s.locus, s.pattern, p.term, p.label, p.kind"""),
    ("haptable", """SELECT locus, label AS haplotype,
               row_number() OVER (PARTITION BY locus ORDER BY last, idx) AS hap_pos, alleles, hap_freq
        FROM (SELECT locus, label, CASE WHEN kind = 'rare' THEN '********' ELSE hap END AS alleles,
                CASE kind WHEN 'base' THEN 2 WHEN 'rare' THEN 1 ELSE 0 END AS last,
                min(hap_index) AS idx, sum(f) AS hap_freq
              FROM pooled GROUP BY ALL)"""),
]


def _model_ctes() -> list[tuple[str, str]]:
    ctes = [
        ("traits", """SELECT iid, 'clinical' AS dataset, 'acct_bal' AS trait_name, acct_bal AS y FROM v_traits
            UNION ALL SELECT iid, 'clinical', 'order_total', order_total FROM v_traits
            UNION ALL SELECT iid, 'proteomics', 'order_count', order_count FROM v_traits
            UNION ALL SELECT iid, 'proteomics', 'founder_score', founder_score FROM v_traits"""),
        ("nt", "SELECT locus, count(*) AS k FROM terms GROUP BY locus"),
        ("xs", f"""SELECT locus, iid, 0 AS i, 1.0::DOUBLE AS x FROM members
            UNION ALL SELECT m.locus, m.iid, t.position, coalesce(c.copies, 0) FROM members m
              JOIN terms t ON m.locus = t.locus
              LEFT JOIN copies c ON c.locus = m.locus AND c.pattern = m.pattern AND c.term = t.term
            UNION ALL SELECT m.locus, m.iid, nt.k + 1, v."Age" FROM members m
              JOIN nt ON m.locus = nt.locus JOIN v_covariates v ON m.iid = v.iid
            UNION ALL SELECT m.locus, m.iid, nt.k + 2, v."Sex" FROM members m
              JOIN nt ON m.locus = nt.locus JOIN v_covariates v ON m.iid = v.iid"""),
        ("xx", """SELECT a.locus, a.i, b.i AS j, sum(a.x * b.x) AS s FROM xs a
            JOIN xs b ON a.locus = b.locus AND a.iid = b.iid GROUP BY a.locus, a.i, b.i"""),
        ("xy", """SELECT a.locus, t.dataset, t.trait_name, a.i, sum(a.x * t.y) AS s FROM xs a
            JOIN traits t ON a.iid = t.iid GROUP BY a.locus, t.dataset, t.trait_name, a.i"""),
        ("yy", """SELECT m.locus, t.dataset, t.trait_name, sum(t.y * t.y) AS s, sum(t.y) AS total,
                     count(*) AS n FROM members m
            JOIN traits t ON m.iid = t.iid GROUP BY m.locus, t.dataset, t.trait_name"""),
        ("m0", f"""SELECT y.locus, y.dataset, y.trait_name, x.i, x.j, x.s FROM xx x JOIN yy y ON x.locus = y.locus
            UNION ALL SELECT locus, dataset, trait_name, i, {_Y}, s FROM xy
            UNION ALL SELECT locus, dataset, trait_name, {_Y}, i, s FROM xy
            UNION ALL SELECT locus, dataset, trait_name, {_Y}, {_Y}, s FROM yy"""),
    ]
    for k in range(_SWEEPS):
        ctes.append((f"m{k + 1}", f"""SELECT m.locus, m.dataset, m.trait_name, m.i, m.j,
              CASE WHEN d.s IS NULL THEN m.s WHEN m.i = {k} AND m.j = {k} THEN -1 / d.s
                   WHEN m.i = {k} OR m.j = {k} THEN m.s / d.s ELSE m.s - a.s * b.s / d.s END AS s
            FROM m{k} m
            LEFT JOIN (SELECT locus, trait_name, s FROM m{k} WHERE i = {k} AND j = {k}) d
              ON m.locus = d.locus AND m.trait_name = d.trait_name
            LEFT JOIN (SELECT locus, trait_name, i, s FROM m{k} WHERE j = {k}) a
              ON m.locus = a.locus AND m.trait_name = a.trait_name AND m.i = a.i
            LEFT JOIN (SELECT locus, trait_name, j, s FROM m{k} WHERE i = {k}) b
              ON m.locus = b.locus AND m.trait_name = b.trait_name AND m.j = b.j"""))
    last = f"m{_SWEEPS}"
    ctes += [
        ("glance", f"""SELECT y.locus, y.dataset, y.trait_name, y.n AS nobs, y.n - nt.k - 3 AS df_residual,
              nt.k + 3 AS p, m.s AS rss, y.s - y.total * y.total / y.n AS null_deviance
            FROM yy y JOIN nt ON y.locus = nt.locus
            JOIN {last} m ON m.locus = y.locus AND m.trait_name = y.trait_name AND m.i = {_Y} AND m.j = {_Y}"""),
        ("names", """SELECT locus, 0 AS i, '(Intercept)' AS term, 'intercept' AS kind FROM nt
            UNION ALL SELECT locus, position, term, kind FROM terms
            UNION ALL SELECT locus, k + 1, 'Age', 'covariate' FROM nt
            UNION ALL SELECT locus, k + 2, 'Sex', 'covariate' FROM nt"""),
        ("coefs", f"""SELECT *, estimate / std_error AS statistic,
              abs(estimate / std_error) >= 1.959963984540054 + 2.372270 / df_residual AS significant FROM (
            SELECT g.locus, g.dataset, g.trait_name, t.term, t.kind AS term_kind, b.s AS estimate,
                   sqrt(g.rss / g.df_residual * -v.s) AS std_error, g.df_residual
            FROM glance g JOIN names t ON g.locus = t.locus
            JOIN {last} b ON b.locus = g.locus AND b.trait_name = g.trait_name AND b.i = t.i AND b.j = {_Y}
            JOIN {last} v ON v.locus = g.locus AND v.trait_name = g.trait_name AND v.i = t.i AND v.j = t.i)"""),
        ("haps", """SELECT t.dataset, t.trait_name, h.* FROM haptable h
            CROSS JOIN (SELECT DISTINCT dataset, trait_name FROM traits) t"""),
        ("dict", """SELECT locus, dataset, trait_name, haplotype,
              CASE WHEN haplotype = 'Ref.' THEN 'Ref.' ELSE 'H' || CAST(row_number() OVER (
                PARTITION BY locus, dataset, trait_name ORDER BY haplotype = 'Ref.', hap_pos) AS VARCHAR) END AS haplo
            FROM haps WHERE haplotype <> 'Hrare'"""),
        ("results", """SELECT d.locus, d.dataset, d.trait_name, d.haplotype, d.haplo, c.estimate, c.std_error,
              c.statistic, c.significant FROM dict d
            LEFT JOIN (SELECT c.*, t.label FROM coefs c JOIN terms t ON c.locus = t.locus AND c.term = t.term
                       WHERE c.term_kind = 'haplotype') c
              ON c.locus = d.locus AND c.dataset = d.dataset AND c.trait_name = d.trait_name
             AND c.label = d.haplotype"""),
    ]
    return ctes


#: The first trait of a dataset, by its place in the phenotype table.
FIRST_TRAIT = """(SELECT arg_min(o.trait_name, o.place) FROM (VALUES ('clinical', 'order_total', 0), ('clinical', 'acct_bal', 1),
    ('proteomics', 'order_count', 0), ('proteomics', 'founder_score', 1)) o(dataset, trait_name, place)
    WHERE o.dataset = h.dataset)"""

_MEMBERS = ("members", """SELECT p.* FROM pats p JOIN v_traits t ON p.iid = t.iid
    JOIN v_covariates c ON p.iid = c.iid""")

# Haplotypes of everybody genotyped.
EM_SQL = with_views("v_dosage", extra=[("pats", PATTERN_CTE), *em_ctes("pats"), *POOL_CTES])
# Haplotypes and models of the individuals with traits and covariates.
ASSOCIATION_CTES = with_views(
    "v_dosage", "v_traits", "v_covariates",
    extra=[("pats", PATTERN_CTE), _MEMBERS, *em_ctes("members"), *POOL_CTES, *_model_ctes()],
)
HAPLOTYPES_ONLY = with_views(
    "v_dosage", "v_traits", "v_covariates",
    extra=[("pats", PATTERN_CTE), _MEMBERS, *em_ctes("members"), *POOL_CTES,
           *[c for c in _model_ctes() if c[0] in ("traits", "haps", "dict")]],
)
