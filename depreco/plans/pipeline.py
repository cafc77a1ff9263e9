"""The monthly factor run as a set of DataFrame stages, each built on first access.

  cost assets  -> filter -> regression rows -> class x age cells (one aggregate) -> schedules -> fit
               -> rows beyond their class cell's thresholds -> decay factor
  comparables  -> filter -> class cells (one aggregate) -> periods and schedules -> retail cells
               -> worst / best-per-year / recency (all from the cells)
  class values -> filter -> class means of both published periods (one aggregate) -> auction means
  publication  -> inheritance of all factor families at once -> one row per class -> rules

Facts are aggregated to the taxonomy before they meet the schedule maps; everything after that is
class- or schedule-grain. Stages that several others read (maps, taxonomy, regression rows, cells, fits, means, class
factors, the class table) are written to the run's own folder under ``spark.checkpoint.dir``
(:class:`depreco.session.RunTables`). No join carries a broadcast hint but the five-row global values:
the planner and adaptive execution choose from the written tables' real sizes, at any scale.

Access to a stage runs the jobs of the written stages below it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import InheritableThread
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depreco.config import Params
from depreco.operators import decay as D
from depreco.operators import hierarchy as H
from depreco.operators import publish as PB
from depreco.operators import ratios as R
from depreco.session import RunTables
from depreco.sources import extracts as X
from depreco.sources import maps as M


class Run:
    """All stages of one run; ``close`` removes the tables it wrote."""

    #: output column -> factor family
    KINDS = {
        "ResidSF": "decay",
        "SFWorstRetail": "worst_retail",
        "SFBestRetail": "best_retail",
        "SFWorstAuction": "worst_auction",
        "SFBestAuction": "best_auction",
    }

    def __init__(self, inputs, p: Params):
        self.inputs, self.p = inputs, p

    @cached_property
    def _tables(self) -> RunTables:
        return RunTables(self.inputs.classifications.sparkSession)

    def keep(self, df: DataFrame) -> DataFrame:
        """A table of the run's own, written and read back."""
        return self._tables.keep(df)

    def close(self) -> None:
        self._tables.close()

    def prepare(self) -> "Run":
        """Run the three independent fact passes side by side.

        They read different facts and share only the maps and input relations, which are resolved
        first. The threads inherit the caller's job group, scheduler pool and local properties."""
        _ = self.schedules, self.inputs.cost_assets, self.inputs.comparables, self.inputs.class_values, self.inputs.class_values_in_progress
        failed: list[BaseException] = []

        def build(name: str) -> None:
            try:
                getattr(self, name)
            except BaseException as e:  # handed to the caller below
                failed.append(e)

        threads = [InheritableThread(target=build, args=(n,)) for n in ("decay", "retail_cells", "auction_means")]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if failed:
            raise failed[0]
        return self

    # -- maps and taxonomy --------------------------------------------------------------------
    @cached_property
    def schedules(self) -> DataFrame:
        return self._tables.keep(M.schedule_inputs(self.inputs.in_map, self.inputs.in_borrow_map, self.p))

    @cached_property
    def outputs(self) -> DataFrame:
        return self._tables.keep(M.schedule_outputs(self.inputs.out_map, self.inputs.out_borrow_map, self.p))

    @cached_property
    def taxonomy(self) -> DataFrame:
        return self._tables.keep(X.taxonomy_parents(self.inputs.classifications, self.p))

    # -- decay ----------------------------------------------------------------------------------
    @cached_property
    def regression_rows(self) -> DataFrame:
        """The rows of the fit in their few columns, written once: every later pass over them reads these."""
        return D.regression_rows(D.regression_input(X.cost_extract(self.inputs.cost_assets, self.p), self.p), self._tables.keep)

    @cached_property
    def decay(self) -> DataFrame:
        keep = self._tables.keep
        return keep(D.decay_fit(self.regression_rows, self.schedules, self.p, keep))

    @cached_property
    def schedule_list(self) -> DataFrame:
        return self.decay.select("Schedule")

    @cached_property
    def decay_class(self) -> DataFrame:
        return D.decay_by_class(D.capped_decay(self.decay, self.p), self.outputs, self.p)

    # -- retail ---------------------------------------------------------------------------------
    @cached_property
    def retail_cells(self) -> DataFrame:
        return self._tables.keep(R.retail_cells(self.inputs.comparables, self.schedules, self.p))

    @cached_property
    def worst_retail_ratio(self) -> DataFrame:
        return R.worst_retail_ratio(self.retail_cells, self.p)

    @cached_property
    def best_retail_ratio(self) -> DataFrame:
        return R.best_retail_ratio(self.retail_cells, self.p)

    @cached_property
    def best_year_pick(self) -> DataFrame:
        return self._tables.keep(R.best_year_pick(self.best_retail_ratio))

    @cached_property
    def recency(self) -> DataFrame:
        return R.recency_factor(self.retail_cells, self.p)

    @cached_property
    def recency_class(self) -> DataFrame:
        return R.recency_by_class(self.recency, self.outputs)

    @cached_property
    def worst_out(self) -> DataFrame:
        return R.on_schedule_list(self.worst_retail_ratio, self.schedule_list)

    @cached_property
    def best_out(self) -> DataFrame:
        return R.on_schedule_list(self.best_year_pick, self.schedule_list)

    # -- auction --------------------------------------------------------------------------------
    @cached_property
    def auction_means(self) -> DataFrame:
        """Per (period, Schedule, PublishYear) means: one pass over the published values, one over
        those in progress."""
        i, p = self.inputs, self.p
        current = X.auction_current(i.class_values_in_progress, p).withColumn("period", F.lit("current"))
        return self._tables.keep(R.auction_means(X.auction_published(i.class_values, p).unionByName(current), self.schedules))

    def auction(self, period: str) -> DataFrame:
        return self.auction_means.where(F.col("period") == period).drop("period")

    @cached_property
    def worst_auction_out(self) -> DataFrame:
        return R.on_schedule_list(R.worst_auction_ratio(self.auction("recession"), self.auction("current"), self.p), self.schedule_list)

    @cached_property
    def best_auction_out(self) -> DataFrame:
        per_year = R.best_auction_ratio(self.auction("best"), self.auction("current"), self.p)
        return R.on_schedule_list(R.best_auction_for_pick(per_year, self.best_year_pick), self.schedule_list)

    # -- inheritance, all factor families in one pass ----------------------------------------
    @cached_property
    def class_start(self) -> DataFrame:
        families = {
            "decay": self.decay.select("Schedule", "factor"),
            "worst_retail": self.worst_out,
            "best_retail": self.best_out,
            "worst_auction": self.worst_auction_out,
            "best_auction": self.best_auction_out,
        }
        long = None
        for kind, df in families.items():
            part = df.select(F.lit(kind).alias("kind"), "Schedule", "factor")
            long = part if long is None else long.unionByName(part)
        return self._tables.keep(H.class_factors(long, self.outputs, self.taxonomy))

    @cached_property
    def inherited(self) -> DataFrame:
        return H.inherit_from(self.class_start, self.p)

    @cached_property
    def worst_class(self) -> DataFrame:
        return self.inherited.where(F.col("kind") == "worst_retail").drop("kind")

    @cached_property
    def globals(self) -> DataFrame:
        """(kind, glob) for every factor family."""
        return H.global_value(self.class_start, self.p)

    # -- publication ----------------------------------------------------------------------------
    @cached_property
    def classes(self) -> DataFrame:
        """One row per output class with its five factors, written once; the rest is arithmetic on it."""
        wide = H.by_class(self.inherited, {k: k for k in self.KINDS.values() if k != "decay"})
        return self._tables.keep(PB.class_table(self.outputs, D.capped_decay(self.decay, self.p), self.recency, wide, self.p))

    @cached_property
    def worst_retail(self) -> DataFrame:
        return self.classes.select("ClassificationId", "SFWorstRetail")

    @cached_property
    def best_retail(self) -> DataFrame:
        return self.classes.select("ClassificationId", "SFBestRetail")

    @cached_property
    def worst_auction(self) -> DataFrame:
        return self.classes.where("has_worst_auction").select("ClassificationId", "SFWorstAuction")

    @cached_property
    def best_auction(self) -> DataFrame:
        return self.classes.select("ClassificationId", "SFBestAuction")

    @cached_property
    def assembled(self) -> DataFrame:
        return self.classes.select("MarketCode", "ClassificationId", *PB.FACTORS)

    @cached_property
    def global_row(self) -> DataFrame:
        return PB.global_row(self.globals, self.KINDS, self.p)

    @cached_property
    def gapped(self) -> DataFrame:
        return PB.enforce_gap(self.global_row.unionByName(self.assembled), self.p)

    @cached_property
    def last_month(self) -> DataFrame:
        return X.last_month(self.inputs.last_month, self.p)

    @cached_property
    def limited(self) -> DataFrame:
        return PB.mom_limit(PB.attach_last_month(self.gapped, self.last_month), self.p)

    @cached_property
    def review(self) -> DataFrame:
        return PB.mom_delta(self.limited)

    @cached_property
    def upload(self) -> DataFrame:
        return PB.upload_table(self.review)

    @cached_property
    def integrity(self) -> DataFrame:
        return PB.map_integrity(self.outputs, self.taxonomy, self.schedules)

    @cached_property
    def checks(self) -> DataFrame:
        counts = PB.reconciliation_checks(self.classes, self.upload, ["MarketCode", "ClassificationId"])
        return counts.unionByName(PB.integrity_checks(self.integrity))


def build(inputs, p: Params) -> Run:
    return Run(inputs, p)


def run(inputs, p: Params) -> DataFrame:
    """The 7-column upload table."""
    return Run(inputs, p).upload
