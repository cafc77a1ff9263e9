"""Registered queries against their DuckDB oracles on the smallest tables, plus sinks."""

import csv
import os
import re
import tempfile
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as E
from depreco.config import FIXTURE_PARAMS as P
from depreco.plans.catalog import ORACLES, QUERIES
from depreco.plans.pipeline import Run
from depreco.sources import fixtures as FX
from depreco.sources.sinks import write_review, write_taxonomy, write_upload
from depreco.streaming import history
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, got) == rows_of(cols, rel.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= E.queries().items() and ORACLES.items() <= E.oracle_sql().items()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["MarketCode", "ClassificationId", "ResidSF", "SFBestRetail", "SFWorstRetail",
                          "SFBestAuction", "SFWorstAuction"]
    assert df.count() > 0


def test_sinks_and_history_round_trip(spark):
    run = Run(FX.load_inputs(spark, SF_SMALL, P), P)
    upload = run.upload
    out = tempfile.mkdtemp(prefix="depreco-sink-", dir="/tmp")
    stamp = datetime(2001, 8, 15, 9, 5)
    up_path = write_upload(upload, out, stamp, "monthly")
    assert os.path.basename(up_path) == "monthly200108150905.csv" and os.path.isfile(up_path)
    with open(up_path) as f:
        lines = f.read().splitlines()
    assert lines[0] == ",".join(upload.columns)
    want = sorted(map(tuple, upload.collect()), key=lambda r: r[:2])
    body = [x.split(",") for x in lines if x != lines[0]]
    assert [(r[0], int(r[1])) for r in body] == [r[:2] for r in want]  # file order
    for got, row in zip(body, want, strict=True):
        assert [None if v == "NA" else pytest.approx(float(v)) for v in got[2:]] == list(row[2:])
    rv_path = write_review(run.review, out, stamp)
    review = spark.read.parquet(rv_path)
    assert review.columns == run.review.columns and sorted(map(tuple, review.collect()), key=str) == sorted(map(tuple, run.review.collect()), key=str)
    files = sorted(f for f in os.listdir(rv_path) if f.startswith("part-"))
    ids = [r.ClassificationId for f in files for r in spark.read.parquet(f"{rv_path}/{f}").collect()]
    assert ids == sorted(ids)
    tx_path = write_taxonomy(run.taxonomy, out, stamp)
    files = sorted(f for f in os.listdir(tx_path) if f.startswith("part-"))
    names = [(r.CategoryName, r.SubcategoryName or "", r.MakeName or "") for f in files for r in spark.read.parquet(f"{tx_path}/{f}").collect()]
    assert names == sorted(names) and len(names) == run.taxonomy.count()
    # month-over-month state: write this month, read it back partition-pruned
    hist = f"{out}/history"
    history.append_month(history.to_history(upload, run.taxonomy, P.effective_date), hist)
    history.append_month(history.to_history(upload, run.taxonomy, P.effective_date), hist)  # idempotent
    month = history.read_month(spark, hist, P.effective_date)
    assert month.count() == upload.count()
    assert history.read_month(spark, hist, date(2001, 6, 30)).count() == 0
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*AppraisalBookPublishDate#\d+ = 2001-07-31", plan)
    run.close()


def test_checks(spark):
    run = Run(FX.load_inputs(spark, SF_SMALL, P), P)
    got = {r.check: r for r in run.checks.collect()}
    for name in ("decay_vs_best_retail", "decay_vs_worst_retail", "decay_vs_best_auction",
                 "unique_MarketCode_ClassificationId"):
        assert got[name].ok, name
    # K13: worst auction is an inner join, so it may hold fewer classes; reported, not fatal
    assert got["decay_vs_worst_auction"].rhs <= got["decay_vs_worst_auction"].lhs
    # K10: classes that are mapped twice lose rows, which the check reports
    assert got["classes_mapped_once"].rhs <= got["classes_mapped_once"].lhs
    folder = run._tables.folder.removeprefix("file:")
    assert os.path.isdir(folder)
    run.close()
    assert not os.path.exists(folder)


def test_table_inputs_match_fixture_inputs(spark):
    """Write the fixture relations as tables, read them back with the declared schemas and
    check the published factors are the same (production reader path)."""
    from depreco.sources.readers import NAMES, TableInputs

    inp = FX.load_inputs(spark, SF_SMALL, P)
    out = tempfile.mkdtemp(prefix="depreco-inputs-", dir="/tmp")
    paths = {}
    for n in NAMES:
        paths[n] = f"{out}/{n}"
        getattr(inp, n).write.mode("overwrite").parquet(paths[n])
    a = Run(inp, P).upload
    for n in ("cost_assets", "out_map"):  # some relations as named tables
        spark.read.parquet(paths[n]).createOrReplaceTempView(f"in_{n}")
        paths[n] = f"in_{n}"
    b = Run(TableInputs(spark, paths, {"cost_assets": "table", "out_map": "table"}), P).upload
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_monthly_job_two_months(spark):
    """Month 1 writes the history; month 2 reads it back as last month's factors."""
    from depreco.plans.job import run_job

    out = tempfile.mkdtemp(prefix="depreco-job-", dir="/tmp")
    hist = f"{out}/history"
    run_job(spark, FX.load_inputs(spark, SF_SMALL, P), P, f"{out}/m1", hist)
    p2 = P.with_(as_of=date(2001, 9, 15))
    paths = run_job(spark, FX.load_inputs(spark, SF_SMALL, p2), p2, f"{out}/m2", hist)
    months = {r[0] for r in history.read_history(spark, hist).select(history.PARTITION).distinct().collect()}
    assert months == {date(2001, 7, 31), date(2001, 8, 31)}
    m1 = {r.ClassificationId: r for r in history.read_month(spark, hist, date(2001, 7, 31)).collect()}
    assert os.path.isfile(paths["upload"]) and _listed(f"{out}/m2") == sorted(os.path.basename(paths[k]) for k in ("upload", "review", "taxonomy"))
    m2 = spark.read.option("header", True).option("inferSchema", True).csv(paths["upload"]).collect()
    moved = [(r, m1[r.ClassificationId]) for r in m2 if r.ClassificationId in m1 and r.ResidSF not in (None, "NA")]
    assert moved and all(abs(float(r.ResidSF) - prev.ResidSf) <= P.mom_cap + 1e-9 for r, prev in moved)


def _listed(folder):
    return sorted(x for x in os.listdir(folder) if not x.endswith(".crc"))


def test_upload_of_many_parts_is_one_ordered_file(spark):
    out = tempfile.mkdtemp(prefix="depreco-sink-", dir="/tmp")
    rows = spark.range(0, 5000, 1, 7).selectExpr("CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B, \"x\"' END AS MarketCode", "cast(5000 - id AS int) AS ClassificationId", "CASE WHEN id % 3 > 0 THEN id / 8 END AS ResidSF")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert rows.orderBy("MarketCode", "ClassificationId").rdd.getNumPartitions() > 3
        path = write_upload(rows, out, datetime(2001, 8, 15, 9, 5))
        write_upload(rows, out, datetime(2001, 8, 15, 9, 5))  # again: replaces it
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert _listed(out) == ["factors200108150905.csv"]
    with open(path, newline="") as f:
        got = list(csv.reader(f, escapechar="\\"))
    assert got[0] == rows.columns and len(got) == 5001
    assert [(r[0], int(r[1])) for r in got[1:]] == sorted((r.MarketCode, r.ClassificationId) for r in rows.collect())
    assert {r[2] for r in got[1:]} >= {"NA", "0.125"}
    empty = write_upload(rows.limit(0), out, datetime(2001, 8, 15, 9, 6))
    with open(empty) as f:
        assert f.read().splitlines() == [",".join(rows.columns)]


def test_a_failure_in_the_middle_publishes_nothing(spark, monkeypatch):
    from depreco.plans import job

    out = tempfile.mkdtemp(prefix="depreco-job-", dir="/tmp")
    hist = f"{out}/history"

    def fails(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(job.history, "to_history", fails)  # upload, review and taxonomy are staged by then
    with pytest.raises(RuntimeError, match="disk full"):
        job.run_job(spark, FX.load_inputs(spark, SF_SMALL, P), P, out, hist)
    assert _listed(out) == []


def test_a_commit_is_finished_by_the_next_run(spark, monkeypatch):
    from depreco.sources import publication

    out = tempfile.mkdtemp(prefix="depreco-pub-", dir="/tmp")
    month = f"{out}/history/AppraisalBookPublishDate=2001-07-31"
    spark.range(3).write.parquet(month)  # an earlier publication of the same month

    def publish():
        p = publication.Publication(spark, out)
        p.stage(f"{out}/a", spark.range(5).write.parquet)
        p.stage(f"{out}/b", spark.range(6).write.parquet)
        p.stage(month, spark.range(7).write.parquet)
        return p

    assert "a" not in _listed(out)
    publish()  # dies before the commit: readers see what was there
    assert spark.read.parquet(f"{out}/history").count() == 3
    moves, real = [], publication.Files.rename

    def dies(self, path, to):
        moves.append(to)
        if len(moves) == 3:  # the commit, the first move, then the end
            raise KeyboardInterrupt
        real(self, path, to)

    p = publish()
    with monkeypatch.context() as m:
        m.setattr(publication.Files, "rename", dies)
        with pytest.raises(KeyboardInterrupt):
            p.commit()
    p.discard_staged()  # what a failing job calls: a committed publication stays
    assert [x for x in _listed(out) if not x.startswith("_")] == ["a", "history"]
    assert sorted(publication.recover(spark, out, f"{out}/history")) == sorted([f"{out}/a", f"{out}/b", month])
    assert _listed(out) == ["a", "b", "history"] and _listed(f"{out}/history") == ["AppraisalBookPublishDate=2001-07-31"]
    assert [spark.read.parquet(x).count() for x in (f"{out}/a", f"{out}/b", month)] == [5, 6, 7]
    assert publication.recover(spark, out, f"{out}/history") == []


def test_a_failed_required_check_stops_the_publication(spark, capsys):
    from depreco.plans.job import REQUIRED, PublishRefused, run_job

    out = tempfile.mkdtemp(prefix="depreco-job-", dir="/tmp")
    with pytest.raises(PublishRefused, match="classes_mapped_once"):  # the fixtures map some classes twice
        run_job(spark, FX.load_inputs(spark, SF_SMALL, P), P, out, f"{out}/history", required=(*REQUIRED, "classes_mapped_once"))
    assert _listed(out) == ["history"] and history.read_history(spark, f"{out}/history").count() == 0  # as for a first run
    said = capsys.readouterr().out
    assert "classes_mapped_once" in said and "DIFFERENT" in said and "upload_vs_history" in said


def test_counts_of_the_writes(spark):
    from depreco.plans.job import observed, written_checks

    out = tempfile.mkdtemp(prefix="depreco-job-", dir="/tmp")
    rows = spark.createDataFrame([("A", 1), ("A", 2), (None, 3), ("B", None)], "MarketCode string, ClassificationId int")
    seen = {}
    for name, df in (("upload", rows), ("review", rows.limit(3))):
        df, seen[name] = observed(df.orderBy("ClassificationId"), name)
        df.write.parquet(f"{out}/{name}")
    assert written_checks(seen) == [("upload_vs_review", 4, 3), ("upload_keys_present", 2, 0)]


def test_unreadable_history_is_an_error(spark):
    """Only a missing folder is a first run."""
    from depreco.plans.job import run_job

    out = tempfile.mkdtemp(prefix="depreco-job-", dir="/tmp")
    broken = f"{out}/history"
    os.makedirs(f"{broken}/AppraisalBookPublishDate=2001-06-30")
    with open(f"{broken}/AppraisalBookPublishDate=2001-06-30/part-0.parquet", "w") as f:
        f.write("not a table")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic"):
        run_job(spark, FX.load_inputs(spark, SF_SMALL, P), P, f"{out}/m", broken)


def test_run_settings():
    from depreco.config import Params
    from depreco.plans.job import settings

    p = settings(Params(), {"country": "CAN", "best_years": [2017, 2018], "mom_cap": 0.05}, date(2020, 7, 1))
    assert (p.country, p.best_years, p.mom_cap, p.as_of) == ("CAN", (2017, 2018), 0.05, date(2020, 7, 1))
    assert settings(Params(), {}, date(2020, 7, 1), written_years=True).best_years == (2015, 2016, 2017, 2018, 2019, 2020)
    with pytest.raises(ValueError, match="unknown settings"):
        settings(Params(), {"contry": "CAN"})


def test_cluster_settings_are_left_alone(monkeypatch):
    """Without a local master no partition count or memory is set."""
    from pyspark.sql import SparkSession

    from depreco import session

    seen = {}

    class Builder:
        def appName(self, _):
            return self

        def master(self, _):
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            return SparkSession.getActiveSession()

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    session.get_spark()
    assert "spark.sql.shuffle.partitions" not in seen and "spark.driver.memory" not in seen
