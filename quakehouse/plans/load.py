"""The whole load in the reference's order (U12) and the duplicate repair.

events -> disasters -> geography (SCD2) -> seismic fact -> disaster fact -> bridge.
Every stage writes its table and the next stage reads it back; all of a run's tables
become visible together (see ``sources.versions``), so a failure at any point leaves
the version before it in force, and a re-run replaces what that run wrote, whole.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quakehouse.operators import bridge as B
from quakehouse.operators import dims as D
from quakehouse.operators import facts as FA
from quakehouse.operators import ingest as I
from quakehouse.operators import quality as Q
from quakehouse.operators import staging as ST
from quakehouse.operators.lookups import keep_where_exists, keep_where_missing
from quakehouse.session import materialize
from quakehouse.sources import sinks
from quakehouse.sources.readers import read_disaster_csv, read_event_geojson
from quakehouse.sources.versions import Change, Tables

RUN = "LoadBatchId"
# (geography, day, cell) keys with more candidate pairs than this are split across tasks
# in the bridge
HOT_KEY_ROWS = 1_000_000
# Tables of a warehouse folder; the run log beside them is append-only.
TABLES = ("event_stage", "event_rejects", "event_keys", "disaster_stage", "disaster_keys",
          "dim_geography", "fact_seismic", "seismic_marks", "fact_disaster", "disaster_marks",
          "bridge", "volume_alarms")


def run_load(spark: SparkSession, events_path: str, disasters_path: str, places: DataFrame,
             master: DataFrame, out_root: str, batch_id: int, as_of: _dt.date,
             events_as_lines: bool = True, hot_key_rows: int | None = HOT_KEY_ROWS,
             first_year: int | None = None, today: _dt.date | None = None,
             min_magnitude: float | None = None, event_type: str | None = None,
             multiline: bool = True) -> Tables:
    """One incremental load run from landed files into a warehouse folder.

    "Already done" (staged ids, promoted ids, linked disasters) is taken from the *other*
    runs' rows only, and ids come from the stored registries, so re-running a run - the
    last or an older one - writes the same rows with the same ids. Returns the tables as
    the run left them.

    With ``first_year`` the load resumes (U8): it reads the feed from the year on that the
    earlier runs' log calls for (a finished year is not read again, the current one always
    is) up to ``today``; a feed landed in ``year=`` folders is pruned to those folders. The
    range is logged. Without it the whole feed is read, and ids decide what is new.
    """
    change = Tables(spark, out_root).change()
    log = _RunLog(spark, f"{out_root.rstrip('/')}/run_log", batch_id)
    today = today or as_of
    try:
        span = None if first_year is None else log.resume("events", first_year, today)
        log.start("events", span)
        feed = read_event_geojson(spark, events_path, lines=events_as_lines,
                                  years=span and (span[0].year, span[1].year))
        feed = I.feed_slice(feed, span, min_magnitude, event_type)
        events = ST.ingest_events(feed, batch_id, places, master, staged=change.read("event_stage", batch_id),
                                  rejected=change.read("event_rejects", batch_id), registry=change.read("event_keys"))
        loaded = _put(change, "event_stage", events.staged, batch_id)
        rejected = _put(change, "event_rejects", events.rejects, batch_id)
        _register(change, "event_keys", events.keys, batch_id)
        _alarm(change, events.landed, batch_id)
        log.done("events", loaded, rejected, events.landed.count())

        log.start("disasters")
        raw = read_disaster_csv(spark, disasters_path, multiline=multiline)
        disasters = ST.disaster_ingest(raw, batch_id, staged=change.read("disaster_stage", batch_id),
                                       registry=change.read("disaster_keys"))
        loaded = _put(change, "disaster_stage", disasters.staged, batch_id)
        _register(change, "disaster_keys", disasters.keys, batch_id)
        log.done("disasters", loaded, 0, disasters.landed.count())

        # U2 + U1 geography: SCD2 transition of the stored dimension
        es, ds = change.read("event_stage"), change.read("disaster_stage")
        codes = D.staged_codes(es.select("ISO3"), ds.select("ISO"))
        old = change.read("dim_geography")
        geo = D.scd2_apply(D.empty_geography(spark) if old is None else old,
                           D.incoming_countries(codes, master), as_of)
        change.put("dim_geography", geo, only=True)
        geo = change.read("dim_geography")
        # U3/U4/U5 facts: promote what other runs have not marked
        seis = FA.fact_seismic(es.drop(RUN), geo, D.magnitude_bands(spark), D.depth_bands(spark),
                               tracker=change.read("seismic_marks", batch_id))
        store_promotion(change, seis, "fact_seismic", "seismic_marks", batch_id,
                        transform=B.with_event_year, partition_by=B.YEAR_COLUMN)
        dis = FA.fact_disaster(ds.drop(RUN), geo, D.deaths_bands(spark), D.affected_bands(spark),
                               D.dim_date(spark), tracker=change.read("disaster_marks", batch_id))
        store_promotion(change, dis, "fact_disaster", "disaster_marks", batch_id)
        # U6 bridge: only disasters without links from other runs
        drop_dangling_links(change)
        br = B.build_bridge(change.read("fact_disaster"), change.read("fact_seismic"),
                            existing=change.read("bridge", batch_id), hot_key_rows=hot_key_rows)
        change.put("bridge", br.withColumn(RUN, F.lit(batch_id)), batch_id)
        change.commit()
    except Exception as exc:
        log.fail(str(exc))
        raise
    log.finish()
    return Tables(spark, out_root)


def store_promotion(change: Change, promo: FA.Promotion, fact: str, tracker: str, batch_id: int,
                    transform=None, partition_by: str | None = None) -> None:
    """U3 write: this run's fact rows and its marks (visible together, with the rest of the change)."""
    rows = promo.fact.withColumn(RUN, F.lit(batch_id))
    change.put(fact, rows if transform is None else transform(rows), batch_id, partition_by)
    change.put(tracker, promo.marks.withColumn(RUN, F.lit(batch_id)), batch_id)


def drop_dangling_links(change: Change) -> None:
    """Links of any run to fact rows that a re-run no longer has, taken out run by run (few runs, if any)."""
    links = change.read("bridge")
    if links is None:
        return
    facts = (("SeismicKey", change.read("fact_seismic")), ("DisasterKey", change.read("fact_disaster")))
    lost = None
    for key, fact in facts:
        gone = keep_where_missing(links, fact, key).select(RUN)
        lost = gone if lost is None else lost.unionByName(gone)
    runs = [r[0] for r in lost.distinct().collect()]
    for run in runs:
        rows = links.filter(F.col(RUN) == run)
        for key, fact in facts:
            rows = keep_where_exists(rows, fact, key)
        change.put("bridge", rows.select(links.columns), run)


def _put(change: Change, name: str, df: DataFrame, run: int) -> int:
    """S3 + A15: write a run's rows and count them during the same write."""
    obs = Observation(f"qh_{name}_{uuid.uuid4().hex[:8]}")
    change.put(name, df.observe(obs, F.count(F.lit(1)).alias("rows")), run)
    return int(obs.get["rows"])


def _register(change: Change, name: str, keys: DataFrame, run: int) -> None:
    """Ids once given out stay in the registry, whatever becomes of the run."""
    if name not in change.tables or not keys.isEmpty():
        change.put(name, keys, f"{run}-{uuid.uuid4().hex[:8]}")


def _alarm(change: Change, landed: DataFrame, run: int) -> None:
    """Rows per year of the feed as read; a year near the source's cap is logged and kept."""
    years = Q.volume_alarm(landed, F.year(F.timestamp_millis("time")))
    change.put("volume_alarms", years.withColumn(RUN, F.lit(run)), run)
    for r in change.read("volume_alarms").filter((F.col(RUN) == run) & (F.col("alarm") == 1)).collect():
        logging.getLogger(__name__).warning("year %s returned %s rows, near the source's limit", r["part"], r["n"])


class _RunLog:
    """Append-only start/finish events; the latest event per run and source is its state."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        self.spark, self.path, self.batch_id = spark, path, batch_id
        self.spans: dict[str, tuple[_dt.date, _dt.date] | None] = {}
        self.counts: dict[str, dict] = {}

    def _write(self, source: str, status: str, error: str | None = None, **counts: int) -> None:
        lit = lambda v: None if v is None else F.lit(v)
        span = self.spans.get(source) or (None, None)
        row = self.spark.range(1).select(*I.run_event(
            F.lit(self.batch_id), source, status, F.current_timestamp(), extract_from=lit(span[0]),
            extract_to=lit(span[1]), error=lit(error), **{k: lit(v) for k, v in counts.items()}))
        sinks.write_table(row, self.path, mode="append")

    def resume(self, source: str, first_year: int, today: _dt.date) -> tuple[_dt.date, _dt.date]:
        """U8 on the log's earlier runs: the range to read."""
        events = self.spark.createDataFrame([], RUN_LOG_SCHEMA)
        if _exists(self.spark, self.path):
            events = self.spark.read.schema(RUN_LOG_SCHEMA).parquet(self.path)
        # a re-run covers what its first attempt covered, so later runs do not count
        earlier = I.run_log_latest(events.filter(F.col("RunId") < self.batch_id))
        year = self.spark.range(1).select(I.resume_year(I.last_success(earlier, source, first_year), today)).first()[0]
        return _dt.date(year, 1, 1), today

    def start(self, source: str, span: tuple[_dt.date, _dt.date] | None = None) -> None:
        self.spans[source] = span
        self._write(source, I.RUN_RUNNING)

    def done(self, source: str, loaded: int, rejected: int, extracted: int) -> None:
        """Remember the counts; the run succeeds only once its tables are in place."""
        self.counts[source] = {"loaded": loaded, "rejected": rejected, "extracted": extracted}

    def finish(self) -> None:
        for source, counts in self.counts.items():
            self._write(source, I.RUN_SUCCESS, **counts)

    def fail(self, error: str) -> None:
        for source in self.spans:
            self._write(source, I.RUN_FAILED, error=error)


RUN_LOG_SCHEMA = ("RunId int, SourceSystem string, EventTime timestamp, Status string, ExtractFrom date, "
                  "ExtractTo date, RowsExtracted int, RowsLoaded int, RowsRejected int, ErrorMessage string")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def repair_disasters(spark: SparkSession, out_root: str, hot_key_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    """U9 on stored tables: keep the lowest id per DisNo, clear tracker, fact and bridge, and rebuild
    them, as one change. Returns (tbl, rows_now) of the rebuilt tables."""
    change = Tables(spark, out_root).change()
    stage = change.read("disaster_stage")
    clean = FA.keep_first(stage, ["DisNo"])
    # only the runs that lose rows are written again
    runs = [r[0] for r in keep_where_missing(stage, clean, "StgId").select(RUN).distinct().collect()]
    for run in runs:
        change.put("disaster_stage", clean.filter(F.col(RUN) == run), run)
    promo = FA.fact_disaster(change.read("disaster_stage").drop(RUN), change.read("dim_geography"),
                             D.deaths_bands(spark), D.affected_bands(spark), D.dim_date(spark))
    # rows of a repair belong to no load run: no later re-run of one replaces them
    change.put("fact_disaster", promo.fact.withColumn(RUN, F.lit(None).cast("int")), "repair", only=True)
    change.put("disaster_marks", promo.marks.withColumn(RUN, F.lit(None).cast("int")), "repair", only=True)
    links = B.build_bridge(change.read("fact_disaster"), change.read("fact_seismic"), hot_key_rows=hot_key_rows)
    change.put("bridge", links.withColumn(RUN, F.lit(None).cast("int")), "repair", only=True)
    change.commit()
    now = Tables(spark, out_root)
    fact, distinct = now.read("fact_disaster"), ["StartDate", "GeographyKey", "TotalDeaths"]
    counts = (("STG_Disaster", now.read("disaster_stage")), ("FactDisaster", fact),
              ("FactDisaster distinct date+geo+deaths", fact.select(*distinct).distinct()),
              ("BridgeDisasterSeismic", now.read("bridge")))
    out = None
    for name, df in counts:
        one = df.agg(F.count(F.lit(1)).alias("rows_now")).select(F.lit(name).alias("tbl"), "rows_now")
        out = one if out is None else out.unionByName(one)
    return out


def rebuild_disasters(stage: DataFrame, geo: DataFrame, seismic: DataFrame, spark: SparkSession
                      ) -> tuple[DataFrame, DataFrame]:
    """Keep the lowest id per DisNo, rebuild the disaster fact from scratch (stored,
    replacing the old one, with an empty tracker), then the bridge over it."""
    clean = FA.keep_first(stage, ["DisNo"])
    fact = materialize(FA.fact_disaster(clean, geo, D.deaths_bands(spark), D.affected_bands(spark),
                                        D.dim_date(spark)).fact, "rebuilt_fact_disaster")
    return fact, B.build_bridge(fact, seismic)
