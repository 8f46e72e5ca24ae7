import os
from types import SimpleNamespace

import pytest

from basketloom.functions.durable import collected, materialize, scratch, shared_folder


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_folder_comes_from_the_session():
    assert shared_folder(session("spark://x", "s3://bucket/tmp/")) == "s3://bucket/tmp"
    assert shared_folder(session("local[2]", "/shared")) == "/shared"


def test_only_local_sessions_get_their_own_folder():
    own = session("local[2]")
    assert shared_folder(own) == shared_folder(own)
    for master in ("spark://x", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(master))


def test_written_tables_keep_rows_and_types(spark):
    df = spark.sql("select 1 a, array('x', 'y') b, timestamp_ntz'2024-01-01 10:00:00' c, cast(null as tinyint) d")
    out = materialize(df)
    assert out.collect() == df.collect() and out.dtypes == df.dtypes
    assert materialize(df.filter("a > 1")).count() == 0


def test_intermediates_go_with_their_block(spark):
    with scratch(spark):
        outer = materialize(spark.range(3))
        with scratch(spark):
            inner = materialize(spark.range(4))
            kept = collected(inner)
            paths = outer.inputFiles() + inner.inputFiles()
        assert outer.count() == 3 and kept.count() == 4
        assert [os.path.exists(p.removeprefix("file://")) for p in inner.inputFiles()] == [False] * len(inner.inputFiles())
    assert paths and not any(os.path.exists(p.removeprefix("file://")) for p in paths)
