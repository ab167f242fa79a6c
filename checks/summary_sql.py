"""Oracle SQL of the annotation documents and their 22-column summary."""

from __future__ import annotations

from checks.views import with_views

PARTS = [
    ("t", "SELECT *, value / 1000 AS f, value / 2000 AS f_afr FROM v_transcripts"),
    ("documents_facts", """SELECT locus, variant, arg_min(term, event_id) AS most_severe_consequence,
        count(*) AS n_transcripts, 'ENST' || min(event_id) AS first_transcript,
        count(*) FILTER (WHERE k % 3 = 0) AS n_frequencies FROM t GROUP BY locus, variant"""),
    ("main", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY variant
        ORDER BY biotype <> 'protein_coding', event_id) AS rn FROM t) WHERE rn = 1"""),
    ("last_freq", "SELECT variant, max_by(f, event_id) AS f, max_by(f_afr, event_id) AS f_afr "
                  "FROM t WHERE k % 3 = 0 AND k % 2 = 0 GROUP BY variant"),
    ("sets", """SELECT locus, variant, arg_min(term, event_id) AS most,
        string_agg(DISTINCT term, ';' ORDER BY term) AS all_c,
        string_agg(DISTINCT term, ';' ORDER BY term) FILTER (WHERE biotype = 'protein_coding') AS coding_c,
        string_agg('rs' || event_id, ';' ORDER BY event_id) FILTER (WHERE k % 4 = 0) AS rs,
        string_agg(DISTINCT CASE WHEN k % 2 = 0 THEN 'benign' ELSE 'pathogenic' END, ';'
          ORDER BY CASE WHEN k % 2 = 0 THEN 'benign' ELSE 'pathogenic' END) FILTER (WHERE k % 5 = 0) AS clin
        FROM t GROUP BY locus, variant"""),
    ("prot", """SELECT variant, string_agg(p, ';' ORDER BY p) AS protein FROM (
        SELECT DISTINCT variant, gene || ':' || CASE WHEN k % 2 = 0 THEN 'A/T' ELSE 'p.' || k END AS p
        FROM t WHERE biotype = 'protein_coding' AND k % 3 = 0 AND k <> 0) GROUP BY variant"""),
    ("summary_by_locus", """SELECT s.locus, s.variant, coalesce(s.rs, '') AS rs_ids, 'A' AS ref_allele, 'T' AS alt_allele,
        s.most AS most_severe_consequence, s.all_c AS all_consequences,
        coalesce(s.coding_c, '') AS coding_consequences, coalesce(p.protein, '') AS protein_changes,
        CASE WHEN m.term = 'missense_variant' THEN 'MODERATE' ELSE 'MODIFIER' END AS impact,
        'ENSG' || m.gene AS gene_id, m.gene AS gene_symbol, 'ENST' || m.event_id AS transcript_id,
        CASE WHEN m.k % 7 = 0 THEN 'YES' ELSE 'NO' END AS canonical_transcript, m.biotype AS biotype,
        '' AS hgnc_id, coalesce(s.clin, '') AS clinical_significance, '' AS sift_prediction,
        '' AS polyphen_prediction, round(f.f, 6) AS gnomad_af, round(f.f_afr, 6) AS gnomad_afr_af,
        CAST(NULL AS DOUBLE) AS gnomad_eur_af, CAST(NULL AS DOUBLE) AS gnomad_eas_af
        FROM sets s JOIN main m ON s.variant = m.variant LEFT JOIN prot p ON s.variant = p.variant
        LEFT JOIN last_freq f ON s.variant = f.variant"""),
    ("summary", "SELECT * EXCLUDE (locus) FROM summary_by_locus"),
]

DOCUMENTS_CTE = with_views("v_transcripts", extra=PARTS[:2])
SUMMARY_CTE = with_views("v_transcripts", extra=PARTS)
