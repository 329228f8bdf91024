"""Every query of the engine's operators gives the rows of its SQL."""

import pytest

from parcela.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, same, name):
    same(QUERIES[name](spark, sf_dir), ORACLE_SQL[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_command_line(spark, sf_dir, tmp_path, capsys):
    from parcela.__main__ import main

    assert main(["list"]) == 0 and "status_histogram" in capsys.readouterr().out.split()
    assert main(["run", "nothing", "--data", sf_dir]) == 2
    assert main(["run", "pending_queue_size", "--data", sf_dir, "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert main(["status", "--store", str(tmp_path / "none")]) == 0 and main(["ddl"]) == 0
    assert "CREATE TABLE IF NOT EXISTS `evaluaciones`" in capsys.readouterr().out


class Noted:
    """An engine that notes its steps."""

    calls: list = []

    def __init__(self, spark):
        from parcela.plans.daily import Settings, Steps

        self.settings = Settings(regions=(1, 2))
        step = lambda name: lambda *a, **k: self.calls.append((name, a, k)) or {"rows_new": 1}
        for name in ("discover", "drain", "retry", "mirror", "cleanup", "sync_communes", "pending"):
            setattr(self, name, step(name))
        self.steps = lambda: Steps(self.discover, self.pending, self.drain, self.mirror, self.cleanup)


def test_steps_from_the_command_line(spark, capsys):
    from parcela.__main__ import main

    make = ["--engine", "tests.test_queries:Noted"]
    Noted.calls.clear()
    for given in (["discover", "--region", "7", "--kind", "2", "--full", "--resume"], ["process-pending", "--limit", "5"], ["retry-failed", "--max-retries", "2"], ["sync-mirror", "--full"], ["cleanup"], ["backfill", "--region", "3", "--discover-only"], ["communes", "--region", "4"], ["daily"]):
        assert main([given[0], *make, *given[1:]]) == 0
    names = [c[0] for c in Noted.calls]
    assert names[:7] == ["discover", "drain", "retry", "mirror", "cleanup", "discover", "sync_communes"] and names[7:] == ["discover", "discover", "pending", "drain", "mirror", "cleanup"]
    assert Noted.calls[0][1:] == ((7, (2,)), {"incremental": False, "resume": True, "most": None}) and Noted.calls[1][2] == {"limit": 5, "region": None}
    assert Noted.calls[5][1:] == ((3,), {"incremental": False, "resume": False, "most": None}) and '"rows_new": 1' in capsys.readouterr().out


@pytest.mark.parametrize("name", ["report_page_1", "report_page_3", "report_monthly_page", "report_envelope_texts"])
def test_reports_are_read_by_all_tasks(spark, sf_dir, name):
    """A scan of narrow rows is one task's."""
    assert QUERIES[name](spark, sf_dir).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", ["cell_blobs", "cell_crop", "glyph_normalise", "listing_grid", "listing_options"])
def test_rows_are_dealt_before_their_pictures_and_pages(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", ["band_merge", "ink_bands", "ink_lines"])
def test_ink_is_joined_with_nothing(spark, sf_dir, name):
    """The most ink of a picture is known where its rows are; a join sent all rows through the driver."""
    assert "Join" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["band_merge", "ink_bands"])
def test_ink_stays_in_the_row_of_its_picture(spark, sf_dir, name):
    """As rows of their own a task's pictures were sorted and grouped, in memory that grew with the table."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and not any(step in plan for step in ("Sort", "Window", "Aggregate"))
