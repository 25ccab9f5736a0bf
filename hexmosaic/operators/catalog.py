"""Source snapshots, category overview and the stage ledger."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name patterns of releases and dated extracts.
RELEASE = r"^(\d{4}-\d{2}-\d{2})\.(\d+)$"
EXTRACT = r"(\w+)-(\d{6})\.osm\.pbf"
STAMP = r"^\d{6}$"


def parse_release(name: Column) -> tuple[Column, Column]:
    """(date, patch) of a release name such as 2026-09-23.1, NULL for other text."""
    ok = name.rlike(RELEASE)
    day = F.when(ok, F.try_to_date(F.regexp_extract(name, RELEASE, 1), "yyyy-MM-dd"))
    return day, F.when(ok, F.regexp_extract(name, RELEASE, 2)).cast("int")


def parse_stamp(name: Column) -> Column:
    """Date of an extract file name or of a bare six-digit stamp, NULL for other text."""
    stamp = F.when(name.rlike(STAMP), name).when(name.rlike(EXTRACT), F.regexp_extract(name, EXTRACT, 2))
    return F.try_to_date(stamp, "yyMMdd")


def pick_snapshots(listing: DataFrame, reference: date) -> DataFrame:
    """(source, snapshot, snapshot_date): latest entry on or before the reference date.

    ``listing`` is (source, name). Within a date the highest patch number wins, compared as a
    number. Sources without an eligible entry have no row.
    """
    day, patch = parse_release(F.col("name"))
    rows = listing.select(
        "source", "name", F.coalesce(day, parse_stamp(F.col("name"))).alias("d"), F.coalesce(patch, F.lit(0)).alias("p")
    ).where(F.col("d") <= F.lit(reference))
    pick = rows.groupBy("source").agg(F.max(F.struct("d", "p", "name")).alias("m"))
    return pick.select("source", F.col("m.name").alias("snapshot"), F.col("m.d").alias("snapshot_date"))


def resolve_snapshots(
    listing: DataFrame, reference: date, max_lag_days: int = 45, cached: DataFrame | None = None
) -> DataFrame:
    """Picked snapshots with ``lag_days`` and ``stale``; a source whose listing is empty uses the
    cached listing instead."""
    if cached is not None:
        online = listing.select("source").distinct()
        listing = listing.unionByName(cached.join(online, "source", "left_anti"))
    lag = F.datediff(F.lit(reference), F.col("snapshot_date"))
    return pick_snapshots(listing, reference).select(
        "*", lag.alias("lag_days"), (F.abs(lag) > max_lag_days).alias("stale")
    )


def require_snapshots(resolved: DataFrame, sources: list[str]) -> DataFrame:
    """The same rows, or LookupError when a source has no snapshot."""
    have = {r["source"] for r in resolved.select("source").collect()}  # one row per source
    missing = [s for s in sources if s not in have]
    if missing:
        raise LookupError(f"no snapshot on or before the reference date for {missing}")
    return resolved


def source_catalogue(sources: DataFrame, resolved: DataFrame, year: int, reference: date) -> DataFrame:
    """A row per source: name, provides, snapshot, snapshot_date, lag_days, url, license, warning.

    ``sources`` is (name, provides, url_template, license, yearly); a template's ``{snapshot}`` and
    ``{year}`` are filled in. A yearly estimate counts as of mid-year. The warning names a missing or
    stale snapshot, or an estimate of another year than the reference's; NULL if all is well.
    """
    rows = sources.join(resolved.withColumnRenamed("source", "name"), "name", "left")
    mid = F.make_date(F.lit(year), F.lit(7), F.lit(1))
    day = F.when(F.col("yearly"), mid).otherwise(F.col("snapshot_date"))
    snapshot = F.when(F.col("yearly"), F.lit(str(year))).otherwise(F.col("snapshot"))
    url = F.replace(F.replace("url_template", F.lit("{snapshot}"), F.coalesce(snapshot, F.lit(""))), F.lit("{year}"), F.lit(str(year)))
    other_year = F.col("yearly") & (F.lit(year) != F.year(F.lit(reference)))
    warning = (
        F.when(other_year, "estimate of another year")
        .when(~F.col("yearly") & F.col("snapshot").isNull(), "no snapshot")
        .when(~F.col("yearly") & F.col("stale"), "stale snapshot")
    )
    return rows.select(
        "name",
        "provides",
        snapshot.alias("snapshot"),
        day.alias("snapshot_date"),
        F.datediff(F.lit(reference), day).alias("lag_days"),
        F.when(snapshot.isNotNull(), url).alias("url"),
        "license",
        warning.alias("warning"),
    )


def explore_categories(pois: DataFrame) -> DataFrame:
    """(top_level, category, n); write it ordered with ``sinks.write_csv``."""
    return pois.groupBy(F.get("category_hierarchy", F.lit(0)).alias("top_level"), "category").agg(
        F.count("*").alias("n")
    )


def by_top_level(counts: DataFrame) -> DataFrame:
    """(top_level, n) rolled up from the category counts, without a second pass over POIs."""
    return counts.groupBy("top_level").agg(F.sum("n").alias("n"))


def top_categories(counts: DataFrame, n: int = 200) -> DataFrame:
    """The n most frequent categories, ties by name."""
    return counts.orderBy(F.desc("n"), "category", "top_level").limit(n)


LEDGER = (
    "stage string, inputs string, rows map<string,double>, outputs array<string>, finished_at string, "
    "reference_date string, config_hash string"
)


class Ledger:
    """Stage ledger as an append-only JSON table: the last entry of a stage counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, stage: str, inputs: str, rows: dict, outputs: list[str], params=None) -> None:
        now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        ref = params.reference_date.isoformat() if params else None
        row = (stage, inputs, {k: float(v) for k, v in rows.items()}, outputs, now, ref, params.hash() if params else None)
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").json(self.path)

    def _exists(self, path: str) -> bool:
        """Whether Spark's readers find the path. Half-written outputs are told by ``invalidate``."""
        try:
            self.spark.read.text(path)
        except AnalysisException:  # no such path
            return False
        return True

    def table(self) -> DataFrame:
        """Latest entry per stage."""
        try:
            rows = self.spark.read.schema(LEDGER).json(self.path)
        except AnalysisException:  # nothing recorded yet
            return self.spark.createDataFrame([], LEDGER)
        last = rows.groupBy("stage").agg(F.max_by(F.struct(*rows.columns), "finished_at").alias("r"))
        return last.select("r.*")

    def invalidate(self, stage: str) -> None:
        """To be called before a stage overwrites its outputs: until it is recorded anew, it is not fresh."""
        self.record(stage, "", {}, [])

    def is_fresh(self, stage: str, inputs: str) -> bool:
        """True when the stage last ran on the same inputs and all its outputs still exist."""
        last = self.table().where(F.col("stage") == stage).first()
        return bool(last) and bool(last["outputs"]) and last["inputs"] == inputs and all(self._exists(p) for p in last["outputs"])
