"""The monthly job: read inputs, compute, stage the upload file, the review table, the taxonomy listing and
the history partition, check them, and publish all four by one commit.

A check that is required and fails leaves nothing published; the others are printed. What an earlier run
committed without coming to its end is finished first, so its month is in the history.

    python -m depreco.plans.job --as-of 2020-06-23 --inputs inputs.json --out /data/factors
    python -m depreco.plans.job --fixture-dir /root/testdata/sf0.01 --out /tmp/factors

``inputs.json`` maps each logical relation (see ``depreco.sources.readers.NAMES``) to a path or,
with ``"formats": {"<relation>": "table"}``, to a named table; other formats are ``csv`` and
``parquet``. With ``--history`` the last month's factors are read from the history table instead of
``last_month``. ``--settings`` names a JSON file with any fields of ``depreco.config.Params``
(country, caps, thresholds, lists); ``--written-best-years`` takes the candidate best years from
the written rule instead of the fixed list.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from depreco.config import FIXTURE_PARAMS, Params, written_best_years
from depreco.plans.pipeline import Run
from depreco.session import get_spark
from depreco.sources import fixtures as FX
from depreco.sources import sinks
from depreco.sources.publication import Publication, recover
from depreco.sources.readers import TableInputs
from depreco.sources.sinks import UPLOAD_PREFIX
from depreco.streaming import history

#: Checks that must hold before anything is published.
REQUIRED = ("unique_MarketCode_ClassificationId", "upload_vs_review", "upload_vs_history", "upload_keys_present")


class PublishRefused(RuntimeError):
    """A required check failed; nothing was published."""


def settings(base: Params, given: dict, as_of: date | None = None, written_years: bool = False) -> Params:
    """``base`` with the given fields; unknown names are an error. Lists become tuples."""
    known = {f.name for f in dataclasses.fields(Params)}
    if unknown := sorted(set(given) - known):
        raise ValueError(f"unknown settings: {unknown}")
    values = {k: tuple(v) if isinstance(v, list) else date.fromisoformat(v) if k == "as_of" else v for k, v in given.items()}
    p = base.with_(**values)
    if as_of:
        p = p.with_(as_of=as_of)
    return p.with_(best_years=written_best_years(p.as_of)) if written_years else p


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``rows`` with its row count and its rows without a key, counted by the write itself."""
    seen = Observation(name)
    no_key = F.count(F.when(F.col("MarketCode").isNull() | F.col("ClassificationId").isNull(), 1))
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), no_key.alias("no_key")), seen


def written_checks(seen: dict[str, Observation]) -> list[tuple[str, int, int]]:
    """(check, lhs, rhs) from what the writes counted."""
    rows = {name: s.get["rows"] for name, s in seen.items()}
    out = [(f"upload_vs_{name}", rows["upload"], n) for name, n in rows.items() if name != "upload"]
    return [*out, ("upload_keys_present", seen["upload"].get["no_key"], 0)]


def run_job(
    spark, inputs, p: Params, out: str, history_path: str | None = None, prefix: str = UPLOAD_PREFIX,
    stamp: datetime | None = None, required: tuple[str, ...] = REQUIRED,
) -> dict:
    """Paths of what was published. A history folder that does not exist yet is a first run; any other
    trouble with reading it is an error. ``PublishRefused`` if a check that ``required`` names fails; a name
    without such a check in this run (the history's, where there is none) asks for nothing."""
    stamp = stamp or datetime.combine(p.as_of, datetime.now().time())
    recover(spark, out, *([history_path] if history_path else []))
    if history_path and history.exists(spark, history_path):
        inputs.last_month = history.read_history(spark, history_path)
    run, published = Run(inputs, p), Publication(spark, out)
    try:
        run.prepare()
        upload, seen_upload = observed(run.upload.orderBy(*sinks.UPLOAD_ORDER), "upload")
        review, seen_review = observed(run.review.orderBy(*sinks.UPLOAD_ORDER), "review")
        seen = {"upload": seen_upload, "review": seen_review}
        paths = {
            "upload": published.stage(sinks.upload_path(out, stamp, prefix), lambda at: sinks.single_csv(upload, at)),
            "review": published.stage(f"{out}/{sinks.output_name(sinks.REVIEW_PREFIX, stamp)}", review.write.parquet),
            "taxonomy": published.stage(f"{out}/{sinks.output_name(sinks.TAXONOMY_PREFIX, stamp)}", run.taxonomy.orderBy(*sinks.TAXONOMY_ORDER).write.parquet),
        }
        if history_path:
            month, seen["history"] = observed(history.to_history(run.upload, run.taxonomy, p.effective_date), "history")
            published.stage(history.partition_path(history_path, p.effective_date), month.drop(history.PARTITION).write.parquet)
            paths["history"] = history_path
        checks = [(r.check, r.lhs, r.rhs) for r in run.checks.collect()] + written_checks(seen)  # a dozen rows
        for name, lhs, rhs in checks:
            print(f"{name}: {lhs} {rhs} {'ok' if lhs == rhs else 'DIFFERENT'}")
        if failed := [name for name, lhs, rhs in checks if name in required and lhs != rhs]:
            raise PublishRefused(", ".join(failed))
        published.commit()
    except BaseException:
        published.discard_staged()
        raise
    finally:
        run.close()
    return paths


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--as-of", type=date.fromisoformat)
    ap.add_argument("--inputs", help="JSON file: relation name -> path or table (and optional formats)")
    ap.add_argument("--fixture-dir", help="derive the inputs from the driver's TPC-H tables instead")
    ap.add_argument("--out", required=True)
    ap.add_argument("--history", help="published-factor history table (read last month, append this month)")
    ap.add_argument("--settings", help="JSON file with fields of Params")
    ap.add_argument("--written-best-years", action="store_true")
    ap.add_argument("--upload-prefix", default=UPLOAD_PREFIX)
    ap.add_argument("--require", nargs="*", default=REQUIRED, help="checks that must hold before anything is published")
    a = ap.parse_args(argv)
    given = {}
    if a.settings:
        with open(a.settings) as f:
            given = json.load(f)
    p = settings(FIXTURE_PARAMS if a.fixture_dir else Params(), given, a.as_of, a.written_best_years)
    spark = get_spark()
    if a.fixture_dir:
        inputs = FX.load_inputs(spark, a.fixture_dir, p)
    else:
        if not a.inputs:
            ap.error("--inputs or --fixture-dir is required")
        with open(a.inputs) as f:
            cfg = json.load(f)
        inputs = TableInputs(spark, cfg, cfg.pop("formats", {}))
    for k, v in run_job(spark, inputs, p, a.out, a.history, a.upload_prefix, required=tuple(a.require)).items():
        print(f"{k}: {v}")


if __name__ == "__main__":
    main()
