from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from locusframe.llm import lattice_score, ngram_join, quality_rules, toxicity
from locusframe.llm.graph import components
from tests.llm.helpers import awkward_rows, docs, prose


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def test_quality_rules_beside_sql_and_brute_force(spark):
    repeats = "a b c " * 30
    rows = awkward_rows() + [(20, repeats, "x"), (21, prose(3, 60) + " ### $$$" * 9, "x"), (22, "l one\n" * 40, "x")]
    frame = docs(spark, rows)
    got = frame.transform(quality_rules.judged).select("doc_id", "text", "rules.*").collect()
    for row in got:
        words = word_list(row.text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        found = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(3)}
        lines = [x for x in (row.text or "").split("\n") if word_list(x)]
        assert row.n_words == len(words)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", row.text or ""))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == len(covered)
        assert row.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (row.base_failed and row.kept)
    connection = duckdb.connect()
    connection.register("documents", frame.select("doc_id", "text").toPandas())
    sql = connection.execute(quality_rules.OP3_SQL).df()
    key = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    plain = lambda r: tuple(None if v != v else v for v in r)
    assert Counter(map(plain, sql[key].itertuples(index=False))) == Counter(tuple(r[k] for k in key) for r in got)
    assert docs(spark, []).transform(quality_rules.judged).count() == 0


def test_quality_rules_stay_in_the_jvm(spark):
    plan = quality_rules.judged(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 4)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_classes(rows, n: int, percent: int) -> dict:
    sets = {}
    for doc_id, text, _ in rows:
        words = (text or "").encode().lower().split()
        width = min(n, len(words))
        sets[doc_id] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets.items():
            for b, y in sets.items():
                shared = len(x & y)
                if a is not None and b is not None and x and y and 100 * shared >= percent * (len(x) + len(y) - shared):
                    low = min(root[a], root[b])
                    changed |= root[a] != low or root[b] != low
                    root[a] = root[b] = low
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_equals_brute_force(spark, n, percent):
    rows = awkward_rows()
    shared = prose(50, 25)
    for i in range(12):
        # A chain of near copies, and texts that share a passage only.
        words = prose(60, 150).split()
        words[: 2 * i] = prose(70 + i, 2 * i).split()
        rows.append((200 + i, " ".join(words), "x"))
        rows.append((300 + i, shared + " " + prose(80 + i, 10 + i), "x"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(docs(spark, rows), n, percent).collect()}
    assert got == brute_classes(rows, n, percent)
    assert ngram_join.classes(docs(spark, []), n, percent).count() == 0


def test_frequent_tokens_do_not_change_results(spark, monkeypatch):
    rows = [(i, prose(1, 30) + " " + prose(i, 3 if i % 2 else 40), "x") for i in range(40)]
    monkeypatch.setattr(ngram_join, "FREQUENT_DOCUMENTS", 20)
    some = sorted(map(tuple, ngram_join.classes(docs(spark, rows), 3, 90).collect()))
    monkeypatch.setattr(ngram_join, "FREQUENT_DOCUMENTS", 1 << 40)
    assert some == sorted(map(tuple, ngram_join.classes(docs(spark, rows), 3, 90).collect()))
    assert some == sorted((i, *v) for i, v in brute_classes(rows, 3, 90).items())


def test_lattice_adds_up_all_segmentations():
    scores = lattice_score.Scores(
        {"▁": -1.0, "▁a": -1.5, "a": -2.0, "b": -2.5, "ab": -1.2, "▁ab": -3.0, "bb": -0.7}, [-5.0] * 256, -0.3
    )
    lattice = lattice_score.Lattice(scores)

    def ways(text: str) -> float:
        if not text:
            return 1.0
        total = math.exp(sum(scores.spelled[b] for b in text[0].encode())) * ways(text[1:])
        for k in range(1, len(text) + 1):
            if text[:k] in scores.pieces:
                total += math.exp(scores.pieces[text[:k]]) * ways(text[k:])
        return total

    for word in ("a", "ab", "abba", "bbabab", "xé", ""):
        assert math.isclose(lattice.word(word), math.log(ways("▁" + word)) - 0.3, rel_tol=1e-12)
    assert lattice.word("a" * 5000) < -1000


def test_base_scores_equal_brute_force(spark):
    rows = awkward_rows()
    learn = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 3 != 1
    marked = docs(spark, rows).withColumn(
        "learn", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) != 1
    )
    got = lattice_score.score_texts(marked, "piece_bpe_32k.model").collect()
    counts: Counter = Counter()
    texts = 0
    for i, text, _ in rows:
        if learn(i):
            texts += 1
            counts.update((text or "").encode().lower().split())
    total, distinct = sum(counts.values()) + texts, len(counts) + 1
    expected = Counter()
    for i, text, _ in rows:
        words = (text or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        base += math.log10((texts + 1) / (total + distinct + 1))
        expected[i, not learn(i), len(words) + 1, sum(counts[w] > 0 for w in words) + 1, total, round(base, 6)] += 1
    assert expected == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    )
    assert all(r.score < 0 for r in got)
    none = docs(spark, []).withColumn("learn", F.lit(True))
    assert lattice_score.score_texts(none, "piece_bpe_32k.model").count() == 0
    unlearned = lattice_score.score_texts(docs(spark).withColumn("learn", F.lit(False)), "piece_bpe_32k.model").collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in unlearned)


def toxic_rows():
    rows, marks = [], []
    for i in range(400):
        text, bad = prose(1000 + i, 40), i % 5 == 0
        if bad:
            text += " " + ["grumpface", "grumpfaced", "nastyword"][i % 3] + " " + prose(i, 5)
        rows.append((i, text, "x"))
        marks.append((i, int(bad), 1))
    return rows, marks


def test_toxicity_restores_and_scores(spark):
    rows, marks = toxic_rows()
    disguised = ["gr0mpf", "grumpf@ce", "g.r.u.m.p.f.a.c.e", "grumpfaaaaace", "g r u m p f a c e"]
    rows += [(900 + i, prose(2000 + i, 30) + f" {w} grumpf4ce " + prose(i, 4), "x") for i, w in enumerate(disguised)]
    rows += [(i + 950 if i is not None else None, t, e) for i, t, e in awkward_rows()]
    labels = spark.createDataFrame([*marks, (3, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs(spark, rows), labels).collect()}
    wrong = [i for i, bad, _ in marks if got[i].predicted != bad]
    assert len(wrong) <= 4
    assert all(got[900 + i].predicted == 1 for i in range(5))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(r.predicted for i, r in got.items() if i is None or i >= 950) == 0
    assert got[951].ids == "x" and got[951].rules == "s"


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs(spark), labels).collect()} == {0.0}
    assert toxicity.toxicity(docs(spark, []), labels).count() == 0


def test_toxicity_reads_spaces_in_the_lattice(spark):
    rows, marks = [], []
    for i in range(600):
        text, bad = prose(5000 + i, 40), i % 5 == 0
        if bad:
            text += " " + ["scum", "ass", "idiot", "d\u00e9bile"][i // 5 % 4] + " " + prose(i, 5)
        elif i % 2:
            text += " such a day here you bile asset of glass and of"
        rows.append((i, text, "x"))
        marks.append((i, int(bad), 1))
    spaced = [
        "such a s c u m here", "y o u i d i o t", "a s s", "s c u m.", "s c u m, then", "d \u00e9 b i l e", "id iot",
        "sc um", "D \u00c9 B I L E", "$ c u m", "s. c. u. m", "s\nc\nu\nm",
    ]
    plain = ["such a day here", "g l a s s", "b i l e", "such a s s e t", "1 2 3 4 5", "a b c"]
    for i, words in enumerate(spaced + plain):
        rows.append((900 + i, f"{prose(7000 + i, 30)} {words} {prose(i, 4)}", "x"))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs(spark, rows), labels).collect()}
    assert [w for i, w in enumerate(spaced) if got[900 + i] != 1] == []
    assert [w for i, w in enumerate(plain) if got[900 + len(spaced) + i] != 0] == []


def test_toxicity_decodes_doubled_letters():
    logp = toxicity.CharModel.counted(toxicity.np.zeros(toxicity.CLASSES**3))
    weights = toxicity._Weights(logp, {"stupid": 3.0, "idiot": 2.0, "moron": 1.5, "ass": 4.0}, {})
    raw = ["stuupid", "idioot", "morron", "stuupiid", "moronn", "ass", "as", "idiot", "tree"]
    assert [weights[x.encode()] for x in raw] == [3.0, 2.0, 1.5, 3.0, 1.5, 4.0, 0.0, 2.0, 0.0]


def test_char_model_restores_leetspeak(spark):
    text = " ".join(["stupid idiot trash loser pathetic the other words"] * 50)
    frame = spark.createDataFrame([(1, text.encode())], "doc_id long, text binary")
    model = toxicity.CharModel.counted(toxicity.char_counts(frame))
    for raw, meant in (("tr4sh", "trash"), ("1d10t", "idiot"), ("st.u.p.i.d", "stupid"), ("loooooser", "loser"), ("p@thetic", "pathetic"), ("trash###", "trash"), ("", "")):
        assert toxicity.restored_token(raw.encode(), model) == meant


def test_toxicity_reads_batches_like_single_texts():
    """Runs do not cross texts, whatever is read together; the gap test does
    not change a reading by signs."""
    rng = __import__("random").Random(3)
    counts = toxicity.np.array([rng.randrange(50) for _ in range(toxicity.CLASSES**3)])
    model = toxicity.CharModel.counted(counts)
    known = {w: -3.0 for w in ("stupid", "idiot", "glass", "as", "so")}
    odd = ["st up id", "$ c u m", "s. c. u. m", "a", "", "1 2 3 b 4 d", "id", "iot x", "d \u00e9 b i l e, \u0391\u03a3. word! wo_rd fooo... !!! ###"]
    texts = [x.encode() for x in odd + [prose(i, 12) for i in range(30)]]
    one = [toxicity.Lexicon(model, known, {"stupid"}).words(x.lower().split()) for x in texts]
    many = toxicity.Lexicon(model, known, {"stupid"}).words_of([x.lower().split() for x in texts])
    assert one == many
    weights = {"stupid": 3.0, "idiot": 2.0, "scum": 1.0}
    alone = [toxicity.measured([x], toxicity._Weights(model, weights, known))[0] for x in texts]
    small = toxicity._Weights(model, weights, known, limit=5)
    small.lexicon.limit = 5
    assert toxicity.measured(texts, small) == alone == toxicity.measured(texts, toxicity._Weights(model, weights, known))
    assert [len(x) for x in toxicity.token_batches(texts, 20)] != [len(texts)]


def test_plain_core_is_what_restoring_gives():
    model = toxicity.CharModel.counted(toxicity.np.ones(toxicity.CLASSES**3))
    for raw in ("word", "word,", "(word)", "word!", "w.o.r.d", "'tis", "glass", "Stra\u00dfe.", "\u0391\u03a3.", "x2", "#tag", "a_b", "--", "", "\u0130ab"):
        token = raw.encode()
        plain = toxicity.plain_core(token)
        word = toxicity._NOISY_END.sub("", raw.lower())
        assert plain is None or (plain == word.strip(toxicity._EDGES) and not toxicity._SUSPECT.search(word))
        assert plain is not None or raw not in ("word", "word,", "Stra\u00dfe.")
        assert isinstance(toxicity.restored_token(token, model), str)
