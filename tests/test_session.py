import os

from tidemark.session import passing_tables, place, scratch_folder, shared_folder, staged


def test_intermediate_results_go_to_the_shared_folder(spark):
    rows = staged(spark.range(5))
    folder = shared_folder(spark)
    assert rows.count() == 5
    assert folder.removeprefix("file:") in rows.inputFiles()[0]
    assert shared_folder(spark) == folder


def test_scratch_is_replaced(spark, tmp_path):
    for n in (3, 4):
        with scratch_folder(str(tmp_path / "scratch")):
            first, second = staged(spark.range(n)), staged(spark.range(1))
            assert (first.count(), second.count()) == (n, 1)
    assert sorted(p.name for p in (tmp_path / "scratch").iterdir()) == ["0", "1"]


def test_given_path_is_replaced(spark, tmp_path):
    path = str(tmp_path / "work")
    staged(spark.range(3), path)
    assert staged(spark.range(2), path).count() == 2


def test_passing_tables_are_removed_but_for_what_has_a_place(spark):
    at = place(spark)
    with passing_tables(spark):
        passing = staged(spark.range(3))
        kept = staged(passing.selectExpr("id + 1 AS id"), at)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in passing.inputFiles())
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3]
