"""One run over the stored tables: load, models, version tables, checks, log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from tierwise.functions.dates import moment
from tierwise.operators.audit import RunLog, require_rows
from tierwise.operators.history import next_versions, open_versions
from tierwise.operators.merge import add_rows, high_water_mark, merge_upsert, purge_keys, since_lookback
from tierwise.operators.quality import run_checks, stored_failures
from tierwise.plans import bronze, gold, marts, silver, snapshots
from tierwise.plans.checks import declared_checks
from tierwise.plans.reference_data import LOOKBACK_DAYS
from tierwise.sources.documents import land_upsert
from tierwise.sources.shared_folder import cut_lineage
from tierwise.sources.tables import BUCKETS, TableStore

LAYERS = {
    "raw_movies": "BRONZE",
    "raw_genres": "BRONZE",
    "bronze_movies_raw": "BRONZE",
    "silver_movies": "SILVER",
    "silver_genres": "SILVER",
    "silver_movie_genres": "SILVER",
    "silver_production_companies": "SILVER",
    "silver_movie_companies": "SILVER",
    "budget_tiers": "GOLD",
    "dim_dates": "GOLD",
    "dim_genres": "GOLD",
    "dim_production_companies": "GOLD",
    "fact_movies": "GOLD",
    "kpi_genre_performance": "GOLD",
    "kpi_yearly_trends": "GOLD",
    "kpi_top_movies": "GOLD",
    "snap_silver_movies": None,
    "snap_dim_genres": None,
}
RAW = ("raw_movies", "raw_genres")
SNAPSHOTS = ("snap_silver_movies", "snap_dim_genres")
MODELS = tuple(t for t in LAYERS if t not in (*RAW, *SNAPSHOTS, "budget_tiers"))
#: Models that do not read each other, step by step, and what a model reads besides raw tables.
STEPS = (
    ("bronze_movies_raw", "silver_genres", "budget_tiers", "dim_dates"),
    ("silver_movies", "silver_movie_genres", "silver_production_companies", "silver_movie_companies", "dim_genres"),
    ("dim_production_companies",),
    ("fact_movies",),
    ("kpi_genre_performance", "kpi_yearly_trends", "kpi_top_movies"),
)
READS = {
    "silver_movies": ("bronze_movies_raw",),
    "silver_movie_genres": ("bronze_movies_raw",),
    "silver_production_companies": ("bronze_movies_raw",),
    "silver_movie_companies": ("bronze_movies_raw",),
    "dim_genres": ("silver_genres",),
    "dim_production_companies": ("silver_production_companies",),
    "fact_movies": (
        "silver_movies", "silver_movie_genres", "silver_movie_companies", "dim_dates", "dim_genres",
        "dim_production_companies", "budget_tiers",
    ),
    "kpi_genre_performance": ("fact_movies", "dim_genres"),
    "kpi_yearly_trends": ("fact_movies",),
    "kpi_top_movies": ("fact_movies", "dim_genres", "dim_production_companies"),
}


class Warehouse:
    """The stored movie warehouse. Every model reads stored tables only."""

    def __init__(
        self,
        store: TableStore,
        lookback_days: int = LOOKBACK_DAYS,
        seeds: str | None = None,
        unknown_members: bool = False,
        buckets: int = BUCKETS,
        threads: int = 4,
    ):
        """``seeds`` is a folder with ``budget_tiers.csv`` (else the fixed tiers hold); ``unknown_members`` adds the member
        that unmatched facts point to in every dimension; ``buckets`` are those of new keyed tables."""
        self.store, self.lookback_days, self.seeds = store, lookback_days, seeds
        self.unknown_members, self.buckets, self.threads = unknown_members, buckets, threads

    def table(self, name: str) -> DataFrame:
        return self.store.read(LAYERS[name], name)

    def tables(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n, layer in LAYERS.items() if self.store.exists(layer, n)}

    def _replace(self, name: str, df: DataFrame) -> int:
        return self.store.replace(df, LAYERS[name], name)

    def load_documents(self, documents: DataFrame, append: bool = False) -> None:
        """Merge stamped documents into the raw table; the newest per movie wins.

        A merge rewrites the hash buckets of the movies in the batch. ``append`` only adds the batch: earlier documents
        stay, bronze keeps the newest, and the load costs as much as the batch. Documents are stored with their hash, so
        that a run does not hash all documents again.
        """
        name, layer = "raw_movies", LAYERS["raw_movies"]
        rows = documents if append else land_upsert(None, documents)
        rows = bronze.with_hash(rows)
        if append or not self.store.exists(layer, name):
            self.store.append(rows, layer, name, ["movie_id"], self.buckets)
        else:
            self.store.update(rows, lambda past: merge_upsert(past, rows, ["movie_id"]), layer, name)
        require_rows(self.table(name), name)

    def load_genres(self, snapshot_row: DataFrame) -> None:
        """Append one reference-list row."""
        self.store.append(snapshot_row, LAYERS["raw_genres"], "raw_genres")

    def _merge(self, name: str, build: Callable, stamp: str, keys, full_refresh: bool, children_of=None, picked: bool = False):
        """Bring a keyed table up to date from the recent part of bronze, in the buckets that it touches.

        Incoming rows that are ``picked`` out of many are written once, as a merge reads them three times.
        """
        layer, bronze_rows = LAYERS[name], self.table("bronze_movies_raw")
        read = self.store.state(layer, name)
        if read is None or full_refresh:
            return self.store.replace(build(bronze_rows), layer, name, children_of or keys, self.buckets)
        mark = high_water_mark(self.store.rows(layer, name, read), stamp)
        recent = since_lookback(bronze_rows, "ingested_at", mark, self.lookback_days)
        incoming = cut_lineage(build(recent)) if picked else build(recent)
        if children_of:
            combine = lambda past: add_rows(purge_keys(past, recent, children_of), incoming)
            touched = recent
        else:
            combine = lambda past: merge_upsert(past, incoming, keys)
            touched = incoming
        self.store.update(touched, combine, layer, name, read)
        return self.table(name).count()

    def _snapshot(self, name: str, current: DataFrame, at) -> int:
        """Rewrite the open versions of a version table and add those that closed; older closed ones stay as they are.

        Of two snapshots that started from one state the second is refused.
        """
        key, check, columns = snapshots.TABLES[name]
        current = current.select(*columns).filter(F.col(key).isNotNull())
        read = self.store.state(None, name)
        if read is None:
            rows = open_versions(current, key, at, snapshots.PREFIX)
        else:
            opened = self.store.rows(None, name, read, {"open"})
            rows = next_versions(opened, current, key, check, at, prefix=snapshots.PREFIX)
        tag = F.when(F.col(f"{snapshots.PREFIX}valid_to").isNull(), "open").otherwise("closed")
        self.store.replace_tags(rows, tag, ["open"], None, name, read)
        return self.table(name).count()

    def build(self, name: str, now: dt.datetime, full_refresh: bool = False) -> int:
        """Rebuild or merge one model from the stored tables below it; returns its row count."""
        t, at = self.table, moment(now)
        if name == "bronze_movies_raw":
            return self._replace(name, bronze.bronze_movies_raw(t("raw_movies")))
        if name == "silver_movies":
            return self._merge(
                name, lambda b: silver.silver_movies(b, at), "_source_ingested_at", ["movie_id"], full_refresh
            )
        if name == "silver_genres":
            return self._replace(name, silver.silver_genres(t("raw_genres"), at))
        if name == "silver_movie_genres":
            return self._merge(
                name, lambda b: silver.silver_movie_genres(b, at), "ingested_at",
                ["movie_id", "genre_id"], full_refresh, ["movie_id"],
            )
        if name == "silver_production_companies":
            return self._merge(
                name, lambda b: silver.silver_production_companies(b, at), "ingested_at",
                ["company_id"], full_refresh, picked=True,
            )
        if name == "silver_movie_companies":
            return self._merge(
                name, lambda b: silver.silver_movie_companies(b, at), "ingested_at",
                ["movie_id", "company_id"], full_refresh, ["movie_id"],
            )
        if name == "budget_tiers":
            return self._replace(name, gold.budget_tiers(self.store.spark, self.seeds))
        if name == "dim_dates":
            return self._replace(name, gold.dim_dates(self.store.spark, unknown_member=self.unknown_members))
        if name == "dim_genres":
            return self._replace(name, gold.dim_genres(t("silver_genres"), at, self.unknown_members))
        if name == "dim_production_companies":
            companies = t("silver_production_companies")
            return self._replace(name, gold.dim_production_companies(companies, at, self.unknown_members))
        if name == "fact_movies":
            fact = gold.fact_movies(
                t("silver_movies"), t("silver_movie_genres"), t("silver_movie_companies"),
                t("dim_dates"), t("dim_genres"), t("dim_production_companies"), t("budget_tiers"), at,
            )
            return self._replace(name, fact)
        if name == "kpi_genre_performance":
            mart = marts.kpi_genre_performance(t("fact_movies"), t("dim_genres"), now.year)
            return self._replace(name, mart)
        if name == "kpi_yearly_trends":
            return self._replace(name, marts.kpi_yearly_trends(t("fact_movies"), at))
        if name == "kpi_top_movies":
            mart = marts.kpi_top_movies(
                t("fact_movies"), t("dim_genres"), t("dim_production_companies"), at
            )
            return self._replace(name, mart)
        if name in SNAPSHOTS:
            return self._snapshot(name, t(name.removeprefix("snap_")), at)
        raise ValueError(f"unknown model {name!r}")

    def run(
        self, now: dt.datetime, models: Sequence[str] = MODELS, full_refresh: bool = False
    ) -> dict[str, int]:
        """Build ``models`` and log the run; returns row counts.

        The models of one step do not read each other and are built side by side. A model that fails leaves the others
        going: only those that read it, or one skipped for it, are skipped. The run is then logged as FAILED, and the
        first error is raised at its end. The seed is loaded again by every run that builds the fact; it is no model.
        """
        log, rows, lost, first = RunLog(self.store), {}, {}, None
        seeds = {"budget_tiers"} if "fact_movies" in models else set()
        log.start(now, len(models), " ".join(models) if tuple(models) != MODELS else "ALL")
        try:
            for step in STEPS:
                wanted = [m for m in step if m in models or m in seeds]
                blocked = [m for m in wanted if any(r in lost for r in READS.get(m, ()))]
                for name in blocked:
                    lost[name] = "skipped"
                    log.model(name, LAYERS[name], now, "skipped")
                ready = [m for m in wanted if m not in blocked]
                with ThreadPoolExecutor(self.threads) as pool:
                    running = {m: pool.submit(self.build, m, now, full_refresh) for m in ready}
                for name, result in running.items():
                    error = result.exception()
                    if error is None and name in seeds:
                        continue
                    if error is None:
                        rows[name] = result.result()
                        log.model(name, LAYERS[name], now, listed=LAYERS[name] == "GOLD")
                    else:
                        lost[name], first = "error", first or error
                        log.model(name, LAYERS[name], now, "error")
        finally:
            log.finish(now)
        if first is not None:
            raise first
        return rows

    def snapshot(self, now: dt.datetime) -> dict[str, int]:
        """Bring the version tables up to the current models."""
        with ThreadPoolExecutor(self.threads) as pool:
            return dict(zip(SNAPSHOTS, pool.map(lambda name: self.build(name, now), SNAPSHOTS), strict=True))

    def test(self, now: dt.datetime, store_failures: bool = True) -> list:
        """Run all declared checks; rows that fail one are kept in the AUDIT table of the checked table.

        Nothing is raised: the summary rows (table, check, failures, status) are returned.
        """
        tables, checks = self.tables(), declared_checks(now.date())
        summary = run_checks(self.store.spark, tables, checks, self.threads).collect()
        if store_failures:
            failing = {(r["table"], r["check"]) for r in summary if r["failures"]}

            def keep(table: str) -> None:
                mine = [c for c in checks if (c.table, c.name) in failing and c.table == table]
                self.store.replace(stored_failures(tables, mine), "AUDIT", f"{table}__failures")

            with ThreadPoolExecutor(self.threads) as pool:
                list(pool.map(keep, sorted({t for t, _ in failing})))
        return summary

    def purge(self, movie_ids: DataFrame) -> None:
        """Delete movies from the raw table and the movie versions.

        Rebuild the models with ``full_refresh`` afterwards.
        """
        if self.store.exists(LAYERS["raw_movies"], "raw_movies"):
            combine = lambda past: purge_keys(past, movie_ids, ["movie_id"])
            self.store.update(movie_ids, combine, LAYERS["raw_movies"], "raw_movies")
        read = self.store.state(None, "snap_silver_movies")
        if read is not None:
            kept = purge_keys(self.store.rows(None, "snap_silver_movies", read), movie_ids, ["movie_id"])
            tag = F.when(F.col(f"{snapshots.PREFIX}valid_to").isNull(), "open").otherwise("closed")
            self.store.replace_tags(kept, tag, ["open", "closed"], None, "snap_silver_movies", read)
