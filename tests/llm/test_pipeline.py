from __future__ import annotations

import corpus_pipeline
from locusframe.llm import registry
from tests.llm.helpers import docs, prose
from tests.llm.test_documents import toxic_rows


def test_stages_keep_what_is_clean_and_drop_what_is_not(spark, tmp_path):
    rows, marks = toxic_rows()
    rows = [(i, f"the {t} and of the or to the in {prose(i, 40)}", e) for i, t, e in rows]
    rows += [(2000 + i, rows[1][1], "x") for i in range(5)]
    rows += [(3000, "short", "x"), (3001, None, "x"), (None, rows[2][1], "x"), (3002, "### $$$ " * 80, "x")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, t) for i, t, _ in marks], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    frame, kept = table, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == table.columns
        out = spark.createDataFrame(out.collect(), table.schema)
        kept.append([r.doc_id for r in out.collect()])
        frame = out
    toxic = {i for i, bad, _ in marks if bad}
    assert len(toxic & set(kept[0])) <= 4 and len(kept[0]) >= len(rows) - len(toxic) - 4
    assert not {3000, 3001, 3002} & set(kept[1])
    assert 1 in kept[2] and not any(i is not None and 2000 <= i < 3000 for i in kept[2]) and None in kept[2]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(kept[2])


def test_registry_names_every_operator():
    assert [int(n[2:].split("_")[0]) for n in registry.QUERIES] == list(range(1, 14))
