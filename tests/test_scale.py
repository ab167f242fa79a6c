"""Work that must spread over tasks, or stay out of the driver, as tables grow."""

from __future__ import annotations

from checks import q_phase, views
from locusframe.operators import glm, reshape
from locusframe.session import broadcast_if_small, spread, tasks_for


def _tables(spark, path):
    people = spark.range(1, 41).selectExpr("id AS c_custkey", "int(id % 25) AS c_nationkey")
    people.coalesce(1).write.parquet(f"{path}/customer.parquet")
    spark.range(25).selectExpr("int(id) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{path}/nation.parquet")
    spark.range(1, 301).selectExpr("id AS p_partkey").write.parquet(f"{path}/part.parquet")
    return str(path)


def test_tasks_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(1000), width=10, task_rows=100).rdd.getNumPartitions() == max(cores, 100)
    assert tasks_for(spark, 0) == cores


def test_cells_of_one_file_are_made_by_many_tasks(spark, tmp_path):
    sf_dir = _tables(spark, tmp_path)
    assert views.table(spark, sf_dir, "customer").rdd.getNumPartitions() == 1
    assert views.v_calls(spark, sf_dir).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1


def test_open_cells_are_not_stored(spark, tmp_path, monkeypatch):
    sf_dir, kept, store = _tables(spark, tmp_path), [], q_phase.materialize
    monkeypatch.setattr(q_phase, "materialize", lambda df, *label: kept.append(label[0]) or store(df, *label))
    vectors = q_phase.open_vectors(spark, sf_dir)
    assert "open-dosage" not in kept and vectors.count() == 40 * 25
    assert {len(r.pattern) for r in vectors.collect()} == {6}


def test_pivot_deals_individuals_to_tasks_by_their_number(spark):
    rows = [("L", f"i{i}", f"s{s}", float(i + s)) for i in range(30) for s in range(4)] + [("L", None, "s1", 0.5)]
    cells = spark.createDataFrame(rows, "locus string, iid string, snp_id string, dosage double")
    wide = reshape.genotype_pivot(cells, ["s0", "s3"], task_rows=2)
    assert wide.rdd.getNumPartitions() == -(-len(rows) // 2)
    assert {(r.iid, r.s0, r.s3) for r in wide.collect()} == {(f"i{i}", float(i), i + 3.0) for i in range(30)} | {(None, None, None)}


def test_only_small_tables_are_broadcast(spark):
    hinted = lambda n: "ResolvedHint" in broadcast_if_small(spark.range(n))._jdf.queryExecution().analyzed().toString()
    # 8 bytes a row: 0.8 MB, and 16 MB.
    assert hinted(100_000) and not hinted(2_000_000)


def test_many_individuals_are_not_broadcast(spark):
    people = spark.range(50).selectExpr("string(id) AS iid", "double(id) AS y")
    genotypes = spark.range(50).selectExpr("'L' AS locus", "string(id) AS iid", "'01' AS pattern")
    few, many = glm._join_subjects(genotypes, people), glm._join_subjects(genotypes, people, most=10)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(few) and "Broadcast" not in plan(many)
    assert sorted(few.collect()) == sorted(many.collect()) and many.count() == 50
