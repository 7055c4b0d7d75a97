from types import SimpleNamespace

import pytest

from skyledger import session


def test_scratch_lies_in_the_shared_folder_and_can_be_cleared(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_one_scratch_path_can_be_dropped(spark):
    kept, dropped = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    for path in (kept, dropped):
        spark.range(3).write.parquet(path)
    session.drop_scratch(spark, dropped)
    assert spark.read.parquet(kept).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(dropped)


def test_a_tidy_session_has_the_settings_of_its_origin(spark):
    name, removal = "spark.sql.shuffle.partitions", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name), spark.conf.get(removal, None)
    spark.conf.set(name, "13")
    try:
        tidy = session.tidy_session(spark)
        assert tidy.conf.get(name) == "13" and tidy.conf.get(removal) == "true"
        assert tidy.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set(name, before[0])
    assert spark.conf.get(removal, None) == before[1]


def bare(master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master=master)
    )


def test_only_a_local_session_may_do_without_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(bare("yarn"), "x")
    assert "skyledger" in session.scratch_path(bare("local[2]"), "x")
