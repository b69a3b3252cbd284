"""Batch runs: every model of a tenant, and every tenant.

Models and tenants are short lists of names; each model is one distributed
plan from source to sink, evaluated once (row counts are observed while it is
written).  A bounded pool of driver threads keeps up to ``workers`` models of
all tenants in work at a time, so that the last tasks of one leave no executor
idle while others wait.  Each model has a job group of its own and runs in its
tenant's scheduler pool (which matters under ``spark.scheduler.mode=FAIR``):
a model that fails, or that takes longer than ``limit_seconds`` (waiting for
executor slots included), is cancelled alone and reported, and the others continue.  The report is a small DataFrame
(one row per model and tenant), in the same order for any number of workers.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.cleanse import CleanseSpec, cleanse, dedupe_rows
from .operators.load import LoadError, Warehouse, load
from .plans import CALENDAR, MODELS, Model, Params, Source

REPORT_SCHEMA = ("tenant string, model string, target string, mode string, status string, "
                 "rows bigint, dropped_duplicates bigint, lost_values bigint, error string, "
                 "finished_at timestamp")


def _failed(tenant: str, model: Model | None, mode: str, error: str) -> tuple:
    return (tenant, model and model.name, model and model.table, mode, "failed", None, None, None, error[:1000], dt.datetime.now())


class _Group:
    """The Spark jobs that one model starts from its thread: cancelled
    together when the block is left by an error or its time is over."""

    def __init__(self, spark: SparkSession, pool: str, what: str, limit_seconds: float | None):
        self.sc, self.pool, self.what, self.limit = spark.sparkContext, pool, what, limit_seconds
        self.name = f"tenantmart-{uuid.uuid4().hex}"
        self.late = threading.Event()
        self.done = threading.Event()

    def _watch(self):
        # jobs that start after the limit are cancelled as well, until the model gives up
        if not self.done.wait(self.limit):
            self.late.set()
            while not self.done.wait(0.2):
                self.sc.cancelJobGroup(self.name)

    def __enter__(self):
        self.before = {k: self.sc.getLocalProperty(k) for k in ("spark.scheduler.pool", "spark.jobGroup.id", "spark.job.description",
                                                                "spark.job.interruptOnCancel")}
        self.sc.setLocalProperty("spark.scheduler.pool", self.pool)
        self.sc.setJobGroup(self.name, self.what, interruptOnCancel=True)
        if self.limit is not None:
            self.watcher = threading.Thread(target=self._watch, daemon=True)
            self.watcher.start()
        return self

    def __exit__(self, kind, value, trace):
        self.done.set()
        if self.limit is not None:
            self.watcher.join()
        if kind is not None:
            self.sc.cancelJobGroup(self.name)        # what the model left running, broadcasts for instance
        for k, v in self.before.items():
            self.sc.setLocalProperty(k, v)
        return False


def _distinct(m: Model, src, params, built: Observation) -> DataFrame:
    """The model's different rows; ``built`` observes how many rows they were
    made of.  It looks at all pieces together: Spark may find out that one has no
    rows, and leave it out."""
    pieces = m.in_pieces(src, params)
    if len(pieces) == 1:
        rows, unit = pieces[0]
        if m.distinct:
            # what is counted comes after: the planner makes one aggregation of the model's last step and this one
            return dedupe_rows(rows, unit).observe(built, F.count(F.lit(1)).alias("rows"))
        return dedupe_rows(rows.observe(built, F.count(F.lit(1)).alias("rows")), unit)
    found = reduce(DataFrame.unionByName, [dedupe_rows(rows, unit, "_copies") for rows, unit in pieces])
    return found.observe(built, F.sum("_copies").alias("rows")).drop("_copies")


def _run_model(spark, src, wh, params, m: Model, tenant, mode, create_or_replace, on_empty, clean, on_loss,
               dedupe_order, limit_seconds) -> tuple:
    """Report row of one model; never raises."""
    group = _Group(spark, tenant or "default", f"{tenant} {m.name}".strip(), limit_seconds)
    try:
        with group:
            if not (mode == "full" and create_or_replace) and not wh.exists(m.table):
                raise LoadError(f"table {wh.name(m.table)} does not exist; create it first")
            built = Observation()
            df = cleanse(_distinct(m, src, params, built), CleanseSpec(dedupe=False, date_columns=m.date_cols)) if clean else m(src, params)
            res = load(df, wh, m.table, mode=mode, keys=m.keys, create_or_replace=create_or_replace,
                       on_empty=on_empty, unique=m.unique, on_loss=on_loss,
                       dedupe_order=(dedupe_order or {}).get(m.name))
            dropped = (built.get.get("rows") or 0) - res.rows if clean else 0
            return (tenant, m.name, m.table, res.mode, res.status, res.rows, dropped,
                    sum(res.losses.values()), None, dt.datetime.now())
    except Exception as e:  # noqa: BLE001 - isolation: report and continue
        late = f"cancelled after {limit_seconds} s; " if group.late.is_set() else ""
        return _failed(tenant, m, mode, f"{late}{type(e).__name__}: {e}")


def _chosen(models) -> list[Model]:
    known = {**MODELS, CALENDAR.name: CALENDAR}
    return [known[m] if isinstance(m, str) else m for m in (models or list(known))]


def _workers(n: int) -> int:
    if n < 1:
        raise ValueError("workers must be at least 1")
    return n


def run_models(spark: SparkSession, src: Source, wh: Warehouse, params: Params | None = None,
               models=None, mode: str = "full", create_or_replace: bool = False,
               on_empty: str = "keep", clean: bool = True, on_loss: str = "raise",
               dedupe_order: dict[str, str] | None = None, tenant: str = "", workers: int = 1,
               limit_seconds: float | None = None) -> DataFrame:
    """Build, clean and load each model (default: all and the calendar), up to
    ``workers`` at a time; one report row per model.  ``dedupe_order`` names,
    by model, the column whose largest value wins among source rows of one
    key."""
    return run_tenants(spark, {tenant: (src, wh)}, params, models=models, mode=mode, create_or_replace=create_or_replace,
                       on_empty=on_empty, clean=clean, on_loss=on_loss, dedupe_order=dedupe_order, workers=workers,
                       limit_seconds=limit_seconds)


def run_tenants(spark: SparkSession, tenants: dict, params: Params | None = None,
                selected=None, models=None, mode: str = "full", create_or_replace: bool = False,
                on_empty: str = "keep", clean: bool = True, on_loss: str = "raise",
                dedupe_order: dict[str, str] | None = None, workers: int = 1,
                limit_seconds: float | None = None) -> DataFrame:
    """``tenants``: name -> (source, warehouse), or a function that opens both.
    ``selected``: names or ``'all'``.  One pool serves the models of all tenants,
    tenant by tenant.  A tenant that cannot be opened is one report row, and the
    rest continue."""
    names = list(tenants) if selected in (None, "all") else list(selected)
    params, chosen = params or Params(), _chosen(models)

    def opened(name):
        try:
            t = tenants[name]
            src, wh = t() if callable(t) else t
            return src, wh
        except Exception as e:  # noqa: BLE001 - the tenant fails, not the run
            return _failed(name, None, mode, f"{type(e).__name__}: {e}")

    with ThreadPoolExecutor(_workers(workers), thread_name_prefix="tenantmart") as pool:
        found = list(pool.map(opened, names))
        waiting = []
        for name, t in zip(names, found):
            if len(t) != 2:
                waiting.append(t)
            else:
                waiting += [pool.submit(_run_model, spark, *t, params, m, name, mode, create_or_replace, on_empty, clean, on_loss,
                                        dedupe_order, limit_seconds) for m in chosen]
        rows = [w if isinstance(w, tuple) else w.result() for w in waiting]
    return spark.createDataFrame(rows, REPORT_SCHEMA)
