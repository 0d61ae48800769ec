"""The pipeline over the given tables, run as far as a query needs it.

Each layer is built once per session and folder and read by the queries after
it, as reports read published tables. `publish` is run by its halves, so queries
on the detail alone do not wait for the exceptions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tieout.contract import DEFAULT, Contract
from tieout.plans import pipeline
from tieout.session import run_folder
from tieout.sources import fixtures
from tieout.sources.lakehouse import Lakehouse, Scratch

# Gold tables by the job that makes them; the rest are made by `present`.
STAGE_OF = {"dq_scorecard": "score", "dq_rule_scorecard": "score", "recon_detail": "tie"}
BEFORE = {"refine": "land", "tie": "refine", "present": "tie", "score": "refine"}
BATCH = "fixture-load"


@dataclass
class Workspace:
    spark: SparkSession
    sf_dir: str
    lake: Lakehouse
    contract: Contract = DEFAULT
    extracts: dict[str, str] = field(default_factory=dict)
    _done: set = field(default_factory=set)
    _tied: DataFrame | None = None

    @classmethod
    def fresh(cls, spark: SparkSession, sf_dir: str) -> "Workspace":
        return cls(spark, sf_dir, Lakehouse(spark, root=run_folder(spark)))

    def rules(self, dataset: str):
        return self.contract.datasets[dataset].active_rules

    def primary_key(self, dataset: str) -> str:
        return self.contract.datasets[dataset].primary_key

    def source(self, dataset: str) -> DataFrame:
        return fixtures.LINES[dataset](self.spark, self.sf_dir)

    def invoices(self) -> DataFrame:
        return fixtures.invoices(self.spark, self.sf_dir)

    def scratch(self) -> Scratch:
        return Scratch(self.spark, run_folder(self.spark))

    def land(self) -> None:
        """Make sure bronze is in place, before queries are built side by side."""
        self._bring("land")

    def bronze(self, dataset: str) -> DataFrame:
        self._bring("land")
        return self._read("bronze", dataset)

    def silver(self, dataset: str) -> DataFrame:
        self._bring("refine")
        return self._read("silver", dataset)

    def quarantine(self, dataset: str) -> DataFrame:
        self._bring("refine")
        return self._read("quarantine", dataset)

    def gold(self, table: str) -> DataFrame:
        self._bring(STAGE_OF.get(table, "present"))
        return self.lake.read("gold", table)

    def every(self, layer: str) -> dict[str, DataFrame]:
        return {name: getattr(self, layer)(name) for name in self.contract.datasets}

    def built(self, *stages: str) -> None:
        """Note that the tables of these stages are in place already."""
        self._done.update(stages)
        if "publish" in stages:
            self._done.update(("tie", "present"))

    def _read(self, layer: str, dataset: str) -> DataFrame:
        return self.lake.read(layer, self.contract.datasets[dataset].table)

    def _bring(self, stage: str) -> None:
        if stage in self._done:
            return
        if stage == "land":
            frames = {name: self.source(name) for name in self.contract.datasets}
            pipeline.land_frames(self.lake, frames, self.sf_dir, self.contract, BATCH)
        else:
            self._bring(BEFORE[stage])
            if stage == "tie":
                self._tied = pipeline.tie(self.lake, self.contract)
            elif stage == "present":
                pipeline.present(self.lake, self._tied, self.contract)
            else:
                getattr(pipeline, stage)(self.lake, self.contract)
        self._done.add(stage)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Workspace.fresh(spark, key[1])
    return _open[key]


def forget() -> None:
    """Make the next query build its layers anew."""
    _open.clear()
