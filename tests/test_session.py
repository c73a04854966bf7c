import pytest

from scopewise import session


def test_discard_empties_a_table(spark):
    stored = session.materialize(spark.range(10), "t")
    assert stored.count() == 10
    path = session._path_of[stored]
    session.discard(stored)
    assert spark.read.parquet(path).count() == 0
    session.discard(stored)


def test_scratch_tables_end_with_their_block(spark):
    outside = session.materialize(spark.range(3), "t")
    with session.scratch_tables() as keep:
        inside = session.materialize(spark.range(4), "t")
        kept = keep(session.materialize(inside, "t"))
        path = session._path_of[inside]
    assert spark.read.parquet(path).count() == 0
    assert kept.count() == 4 and outside.count() == 3


def test_a_failing_block_leaves_nothing(spark):
    before = set(session._live)
    with pytest.raises(ValueError), session.scratch_tables():
        session.materialize(spark.range(4), "t")
        raise ValueError
    assert set(session._live) == before


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="share"):
        session.scratch_path(Session, "t")
