"""The derived warehouse over the test tables.

Order follows the reference load: staging -> geography (SCD2) -> seismic fact
-> disaster fact -> bridge. Like the reference, every stage reads the *stored*
tables of the stage before: staging, dimensions and facts are written once per
session as parquet under the shared checkpoint folder (``spark.checkpoint.dir``)
and read back; the bridge alone is a view over the stored facts. That cuts lineage (a lost executor recomputes from files, not
from the raw inputs) and makes each later step a plain, pushdown-friendly scan.

The ``*_plan`` attributes are the transformations themselves (what the
registered queries time and check); the plain attributes are the stored tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from quakehouse.operators import bridge as B
from quakehouse.operators import dims as D
from quakehouse.operators import facts as FA
from quakehouse.plans import fixtures as FX
from quakehouse.session import scratch_path
from quakehouse.sources import sinks

# ---------------------------------------------------------------- fixed values
# Load date used for the first dimension load in the derived test warehouse.
AS_OF = _dt.date(2024, 1, 1)

_STORED: dict[tuple, str] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table is still there (the shared folder may be cleaned)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@dataclass
class Warehouse:
    spark: SparkSession
    sf_dir: str
    as_of: _dt.date = AS_OF
    key_mode: str = "stgid"

    # ------------------------------------------------------------ storage
    def stored(self, name: str, build: Callable[[], DataFrame],
               partition_by: str | None = None) -> DataFrame:
        """Write ``build()`` once per session under the shared folder; read it back.

        Staging tables are partitioned by their load batch, like the batch sink,
        so batch/year filters prune files.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir.rstrip("/"),
               self.as_of, self.key_mode, name)
        path = _STORED.get(key)
        if path is None or not _exists(self.spark, path):
            path = scratch_path(self.spark, name)
            df = build()
            if partition_by:
                sinks.append_batch(df, path, partition_by)
            else:
                df.write.mode("overwrite").parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(path)

    # ------------------------------------------------------------ inputs
    @cached_property
    def event_stage(self) -> DataFrame:
        return self.stored("event_stage", lambda: FX.event_stage(self.spark, self.sf_dir),
                           partition_by="LoadBatchId")

    @cached_property
    def disaster_stage(self) -> DataFrame:
        return self.stored("disaster_stage", lambda: FX.disaster_stage(self.spark, self.sf_dir),
                           partition_by="LoadBatchId")

    @cached_property
    def master(self) -> DataFrame:
        return FX.country_master(self.spark, self.sf_dir)

    # ------------------------------------------------------------ dimensions
    @cached_property
    def dim_date(self) -> DataFrame:
        return D.dim_date(self.spark)

    @cached_property
    def mag_bands(self) -> DataFrame:
        return D.magnitude_bands(self.spark)

    @cached_property
    def depth_bands(self) -> DataFrame:
        return D.depth_bands(self.spark)

    @cached_property
    def deaths_bands(self) -> DataFrame:
        return D.deaths_bands(self.spark)

    @cached_property
    def affected_bands(self) -> DataFrame:
        return D.affected_bands(self.spark)

    @cached_property
    def codes(self) -> DataFrame:
        """Distinct staged country codes (the source's temp table of incoming codes)."""
        return self.stored("codes", lambda: D.staged_codes(self.event_stage.select("ISO3"),
                                                            self.disaster_stage.select("ISO")))

    @cached_property
    def incoming(self) -> DataFrame:
        return D.incoming_countries(self.codes, self.master)

    @property
    def dim_geo_plan(self) -> DataFrame:
        return D.scd2_apply(D.empty_geography(self.spark), self.incoming, self.as_of)

    @cached_property
    def dim_geo(self) -> DataFrame:
        return self.stored("dim_geo", lambda: self.dim_geo_plan)

    # ------------------------------------------------------------ facts
    @cached_property
    def seismic(self) -> FA.Promotion:
        return FA.fact_seismic(self.event_stage, self.dim_geo, self.mag_bands, self.depth_bands,
                               key_mode=self.key_mode)

    @cached_property
    def disaster(self) -> FA.Promotion:
        return FA.fact_disaster(self.disaster_stage, self.dim_geo, self.deaths_bands,
                                self.affected_bands, self.dim_date, key_mode=self.key_mode)

    @property
    def fact_seismic_plan(self) -> DataFrame:
        return self.seismic.fact

    @property
    def fact_disaster_plan(self) -> DataFrame:
        return self.disaster.fact

    @cached_property
    def fact_seismic(self) -> DataFrame:
        """Stored partitioned by event year (the bridge prunes years dynamically)."""
        return self.stored("fact_seismic", lambda: B.with_event_year(self.fact_seismic_plan),
                           partition_by=B.YEAR_COLUMN)

    @cached_property
    def fact_disaster(self) -> DataFrame:
        return self.stored("fact_disaster", lambda: self.fact_disaster_plan)

    # ------------------------------------------------------------ bridge
    @property
    def bridge_plan(self) -> DataFrame:
        return self._links()

    def _links(self, **how) -> DataFrame:
        # same hot-key guard as the whole load (inactive unless a day is that hot)
        from quakehouse.plans.load import HOT_KEY_ROWS
        return B.build_bridge(self.fact_disaster, self.fact_seismic, hot_key_rows=HOT_KEY_ROWS, **how)

    @cached_property
    def bridge(self) -> DataFrame:
        """The links as a view over the stored facts: they grow with the square of the rows, so they are made anew
        where they are counted and not stored."""
        return self.bridge_plan

    def tables(self) -> dict[str, DataFrame]:
        """Warehouse tables by their reference names."""
        return {
            "FactSeismic": self.fact_seismic,
            "FactDisaster": self.fact_disaster,
            "BridgeDisasterSeismic": self.bridge,
            "DimGeography": self.dim_geo,
            "DimDate": self.dim_date,
            "DimMagnitude": self.mag_bands,
            "DimSeismicDepth": self.depth_bands,
            "DimSeverityDeaths": self.deaths_bands,
            "DimSeverityAffected": self.affected_bands,
        }
