"""The load without a database: statements, their order, commit and rollback."""

from contextlib import contextmanager

import pytest

from pricetide.sinks import jdbc


def test_statements():
    assert jdbc.delete_statement("dw.offers") == "DELETE FROM dw.offers WHERE snapshot_date = ?"
    assert jdbc.insert_statement("offers", "offers_staging", ["a", "b"]) == (
        "INSERT INTO offers (a, b) SELECT a, b FROM "
        "(SELECT DISTINCT load_row, a, b FROM offers_staging) AS staged"
    )


@pytest.mark.parametrize("name", ["x; DROP TABLE y", "a b", "", "1a", 'a"b', "a.b.c"])
def test_names_that_are_not_plain_are_refused(name):
    with pytest.raises(ValueError):
        jdbc.delete_statement(name)


class Connection:
    def __init__(self, log, fail=False):
        self.log, self.fail = log, fail

    def __getattr__(self, name):
        def call(*arguments):
            self.log.append((name, *map(str, arguments)))
            if self.fail and name == "createStatement":
                raise RuntimeError("insert failed")
            return self

        return call


@pytest.fixture
def recorded(monkeypatch):
    log = []

    def use(fail=False):
        @contextmanager
        def transaction(spark, target):
            connection = Connection(log, fail)
            try:
                yield connection
                connection.commit()
            except BaseException:
                connection.rollback()
                raise

        monkeypatch.setattr(jdbc, "transaction", transaction)
        monkeypatch.setattr(
            jdbc, "append_rows", lambda df, t, table, mode="append": log.append((mode, table))
        )
        return log

    return use


def test_load_order(spark, recorded):
    log = recorded()
    df = spark.createDataFrame([(1,)], "x int")
    jdbc.load_snapshots(df, jdbc.Target("jdbc:none"), "t", ["2026-01-01", "2026-01-02"])
    staging = log[0][1]
    assert staging.startswith("t_staging_") and len(staging) > 20
    assert log == [
        ("overwrite", staging),
        ("prepareStatement", "DELETE FROM t WHERE snapshot_date = ?"),
        ("setDate", "1", "2026-01-01"),
        ("executeUpdate",),
        ("setDate", "1", "2026-01-02"),
        ("executeUpdate",),
        ("close",),
        ("createStatement",),
        ("executeUpdate", jdbc.insert_statement("t", staging, ["x"])),
        ("executeUpdate", f"DROP TABLE {staging}"),
        ("close",),
        ("commit",),
    ]


def test_failed_load_rolls_back(spark, recorded):
    log = recorded(fail=True)
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(RuntimeError):
        jdbc.load_snapshots(df, jdbc.Target("jdbc:none"), "t", ["2026-01-01"])
    assert log[-1] == ("rollback",) and ("commit",) not in log


def test_password_is_not_shown():
    assert "secret" not in repr(jdbc.Target("jdbc:none", properties={"password": "secret"}))
