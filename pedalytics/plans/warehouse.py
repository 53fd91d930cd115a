"""The pipeline's tables below one root folder, and the jobs that build them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalytics import config, schemas
from pedalytics.config import LAYOUTS, NYC, REGIONS, TABLE_OF_LAYOUT, Compat, Region
from pedalytics.operators.joins import unseen_by_file
from pedalytics.operators.unify import to_unified, union_layouts
from pedalytics.plans import audit, calendar, reports, rides, stations, views
from pedalytics.plans.ingest import IngestResult, archive_loaded, ingest, uncommitted, visible
from pedalytics.session import delete
from pedalytics.sinks import tables as sink
from pedalytics.sinks.tables import Written
from pedalytics.sources import csv_parts


@dataclass
class Warehouse:
    """Staging, unified, star and log tables as Parquet folders below ``root``."""

    spark: SparkSession
    root: str
    compat: Compat = field(default_factory=Compat)
    layout_of_key: Mapping[str, str] = field(default_factory=lambda: config.LAYOUT_OF_KEY)
    start: dt.date = config.CALENDAR_START
    end: dt.date = config.CALENDAR_END
    _published: bool = field(default=False, init=False, repr=False)

    # ---- table locations ------------------------------------------------------------------

    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"

    def _exists(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def _read(self, schema: str, table: str, columns: T.StructType | None = None) -> DataFrame | None:
        """The table, or ``None`` (an empty frame if its columns are given) before its first load."""
        path = self.path(schema, table)
        if self._exists(path):
            reader = self.spark.read if columns is None else self.spark.read.schema(columns)
            return reader.parquet(path)
        return None if columns is None else self.spark.createDataFrame([], columns)

    def staging(self, region: Region, layout: str) -> DataFrame:
        """Good rows of a staging table that the log has committed."""
        columns = T.StructType(
            [
                *schemas.LAYOUT_SCHEMA[layout].fields,
                *schemas.STAGING_META.fields,
                T.StructField("_load", T.LongType()),
                T.StructField("_rejected", T.BooleanType()),
            ]
        )
        table = TABLE_OF_LAYOUT[layout]
        rows = self._read(region.staging_schema, table, columns)
        mine = (F.col("sf_schema") == region.staging_schema) & (F.col("sf_table") == table)
        return visible(rows, self.log().filter(mine))

    def manifest(self) -> DataFrame:
        return self._read("LOGGING", "STAGE_MANIFEST", schemas.STAGE_MANIFEST)

    def log(self) -> DataFrame:
        return self._read("LOGGING", "INGEST_LOG", schemas.INGEST_LOG)

    def trips(self, region: Region) -> DataFrame:
        return self._read(region.staging_schema, "TRIPS_ALL", schemas.TRIPS_ALL)

    def dates(self, region: Region = NYC) -> DataFrame:
        return self._read(_star(region), "DIM_DATES")

    def stations(self, region: Region) -> DataFrame:
        return self._read(_star(region), "DIM_STATION")

    def fact(self, region: Region) -> DataFrame | None:
        return self._read(_star(region), "FACT_RIDE")

    # ---- jobs -----------------------------------------------------------------------------

    def register_parts(self, part_manifest: DataFrame, replace: bool = False) -> Written:
        """Add routed parts that are not registered yet; ``replace`` starts over."""
        rows = audit.manifest_rows(audit.routed(part_manifest, self.layout_of_key))
        known = None if replace else self.manifest()
        path = self.path("LOGGING", "STAGE_MANIFEST")
        mode = "overwrite" if replace else "append"
        return sink.write(audit.new_manifest_rows(rows, known), path, "STAGE_MANIFEST", mode)

    def ingest(
        self,
        inbox: str,
        region: str = "all",
        max_attempts: int | None = None,
        reset_failed: bool = False,
        force: bool = False,
    ) -> IngestResult:
        result = ingest(
            self.spark,
            self.manifest(),
            self.log(),
            inbox,
            self.path,
            self.path("LOGGING", "INGEST_LOG"),
            region,
            max_attempts,
            reset_failed,
            force,
        )
        self._refresh_views()
        return result

    def archive_loaded(self, inbox: str, archive: str | None = None) -> int:
        """Move the parts that are loaded out of ``inbox`` (None: delete them); how many there were."""
        return archive_loaded(self.spark, self.log(), inbox, archive)

    def drop_uncommitted(self, region: Region, layout: str) -> int:
        """Delete what runs that broke off have left in a staging table; not while an ingest runs."""
        path = self.path(region.staging_schema, TABLE_OF_LAYOUT[layout])
        left = uncommitted(self.spark, path, self.log())
        for folder in left:
            delete(self.spark, folder)
        return len(left)

    def load_layout(
        self, region: Region, layout: str, files: Sequence[str] | None = None
    ) -> Written:
        """Append one layout's trips that are not unified yet."""
        return self._load(to_unified(self._of_files(self.staging(region, layout), files), layout), region)

    def load_trips(self, region: Region, files: Sequence[str] | None = None) -> Written:
        """Append the new trips of all three layouts ; of the target only one row a file is shuffled."""
        staged = {x: self._of_files(self.staging(region, x), files) for x in LAYOUTS}
        return self._load(union_layouts(staged), region)

    def load_trips_from(self, staging: Mapping[str, DataFrame], region: Region) -> Written:
        """As ``load_trips``, from given staging frames."""
        return self._load(union_layouts(staging), region)

    @staticmethod
    def _of_files(staged: DataFrame, files: Sequence[str] | None) -> DataFrame:
        return staged if files is None else staged.filter(F.col("_source_file").isin(list(files)))

    def _load(self, trips: DataFrame, region: Region) -> Written:
        target = self._read(region.staging_schema, "TRIPS_ALL")
        path = self.path(region.staging_schema, "TRIPS_ALL")
        return sink.append(unseen_by_file(trips, target), path, "TRIPS_ALL")

    def build_dates(self) -> Written:
        """Rebuild the calendar and give every region the same one."""
        dates = calendar.dim_dates(self.spark, self.start, self.end, self.compat)
        done = [
            sink.replace(dates.coalesce(1), self.path(_star(r), "DIM_DATES"), "DIM_DATES")
            for r in REGIONS.values()
        ]
        return done[0]

    def build_stations(self, region: Region) -> Written:
        dim = stations.dim_station(self.trips(region), region, self.layout_of_key, self.compat)
        path = self.path(_star(region), "DIM_STATION")
        return sink.replace(dim.sort("station_name"), path, "DIM_STATION")

    def build_fact(self, region: Region, full_reload: bool = False) -> Written:
        """Append rides not in the fact yet, or reload it as a whole."""
        rows = rides.fact_ride(
            self.trips(region),
            self.stations(region),
            None if full_reload else self.fact(region),
            self.start,
            self.end,
            self.layout_of_key,
            self.compat,
        )
        done = sink.write_fact(rows, self.path(_star(region), "FACT_RIDE"), "FACT_RIDE", full_reload)
        self._refresh_views()
        return done

    def compact_fact(self, region: Region, most_files: int = 4) -> int:
        """Write months that lie in more than ``most_files`` files anew; how many there were."""
        return sink.compact_fact(self.spark, self.path(_star(region), "FACT_RIDE"), most_files)

    # ---- reports --------------------------------------------------------------------------

    def ridership_over_time(self, region: Region) -> DataFrame:
        return reports.ridership_over_time(self.fact(region), self.dates(region))

    def top_stations(self, region: Region) -> DataFrame:
        return reports.top_stations(self.fact(region), self.stations(region))

    def top_routes(self, region: Region) -> DataFrame:
        return reports.top_routes(self.fact(region), self.stations(region), region)

    def pending_files(self, region: str = "all") -> DataFrame:
        return audit.pending_files(self.manifest(), self.log(), region)

    def row_count_check(self) -> DataFrame:
        counted = {
            (r.staging_schema, TABLE_OF_LAYOUT[x]): self.staging(r, x)
            for r in REGIONS.values()
            for x in LAYOUTS
        }
        return audit.row_count_check(self.log(), audit.actual_counts(counted))

    def _refresh_views(self) -> None:
        if self._published:
            self.publish_views()

    def _folder(self, schema: str, table: str) -> str | None:
        """The table's folder, or ``None`` before its first load."""
        return self.path(schema, table) if self._exists(self.path(schema, table)) else None

    def publish_views(self) -> None:
        """Reports and audit views of all regions as stored views.

        A view shows the tables as they are when it is read, whatever wrote them. A view is made once
        its tables exist; after that, ``ingest`` and ``build_fact`` add those that were not there yet.
        """
        self._published = True
        for region in REGIONS.values():
            suffix = region.staging_schema.removeprefix("STAGING_").lower()
            fact, dim, dates = (self._folder(_star(region), t) for t in ("FACT_RIDE", "DIM_STATION", "DIM_DATES"))
            if fact and dates:
                sink.create_view(self.spark, f"rpt_ridership_over_time_{suffix}", views.ridership_over_time(fact, dates))
            if fact and dim:
                sink.create_view(self.spark, f"rpt_top_stations_{suffix}", views.top_stations(fact, dim))
                sink.create_view(self.spark, f"rpt_top_routes_{suffix}", views.top_routes(fact, dim, region))
        manifest, log = (self._folder("LOGGING", t) for t in ("STAGE_MANIFEST", "INGEST_LOG"))
        if manifest:
            sink.create_view(self.spark, "v_pending_files", views.pending_files(manifest, log))
        if log:
            sink.create_view(self.spark, "v_latest_ingest_status", views.latest_ingest_status(log))
            names = [(r.staging_schema, t) for r in REGIONS.values() for t in TABLE_OF_LAYOUT.values()]
            staged = {n: path for n in names if (path := self._folder(*n))}
            if staged:
                sink.create_view(self.spark, "v_table_row_counts", views.table_row_counts(log, staged, csv_parts.LABEL_SQL))


def _star(region: Region) -> str:
    return region.staging_schema.replace("STAGING_", "INT_UDM_")
