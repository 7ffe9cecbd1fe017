"""The location dimension as a stored table that grows by the places of staged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.operators import dimensions, ordering
from wattlake.sources.versions import VersionedStore, Write

LOCATIONS_TABLE = "dim_location"


class StoredLocations:
    """Locations under a root of versioned tables, with the seeds as their first rows."""

    def __init__(self, store: VersionedStore) -> None:
        self.store = store

    def read(self) -> DataFrame:
        """All locations of the newest commit; the seeds alone before any."""
        snapshot = self.store.snapshot()
        if LOCATIONS_TABLE not in snapshot.folders:
            return dimensions.dim_location(self.store.spark)
        return self.store.read(LOCATIONS_TABLE, schemas.DIM_LOCATION, snapshot)

    def grow(self, staged: DataFrame) -> int:
        """Add the places of rows with ``location`` and ``location_type``; gives how many were new.

        A place that is known keeps its row and key. New ones get the keys after the greatest, in
        the order of their codes, with the code as their name and the least of their types; repeated
        rows are one place, and NULL or blank codes are none. Another writer's commit in between
        raises ConflictError and changes nothing, so that no key is given twice; call it again then.
        """
        base = self.store.snapshot()
        stored = LOCATIONS_TABLE in base.folders
        known = (
            self.store.read(LOCATIONS_TABLE, schemas.DIM_LOCATION, base)
            if stored
            else dimensions.dim_location(self.store.spark)
        )
        places = (
            staged.where("trim(location) <> ''")
            .groupBy(F.col("location").alias("location_code"))
            .agg(F.min("location_type").alias("location_type"))
        )
        new = ordering.numbered(
            dimensions.insert_if_absent(known, places, ["location_code"]), ["location_code"]
        )
        added = new.count()
        if not added and stored:
            return 0
        last = known.agg(F.max("location_key")).first()[0] or 0
        given = {
            "location_key": F.lit(last) + F.col("position"),
            "location_name": F.col("location_code"),
        }
        rows = new.withColumns(given).select(
            *(
                (F.col(f.name) if f.name in (*given, *places.columns) else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in schemas.DIM_LOCATION.fields
            )
        )
        rows = rows if stored else known.unionByName(rows)
        self.store.commit({LOCATIONS_TABLE: Write(rows, (), appends=stored)}, base)
        return added
