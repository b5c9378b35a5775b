"""Published tables: plain Parquet folders, divided by month, by day or by key.

Facts are kept per month, large dimensions in buckets of their key's hash. An update reads and rewrites only the
folders that hold its keys. All tables of an update are prepared first, in a folder of their own inside the warehouse, and
moved to the place of the published ones when every step has succeeded; an update that fails while it prepares has changed
nothing, and one that fails while it moves folders is mended by applying it again. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from qualitymart import schemas as S
from qualitymart.operators import upsert
from qualitymart.session import cut, move, no_rows, parts_in, read_or_none, remove, sized, together
from qualitymart.sources.star import Star

#: Tables kept per value of a column.
DATED = {
    "fact_test_run": "month",
    "fact_test_step_result": "month",
    "fact_defect_link": "month",
    "fact_cycle_snapshot": "snapshot_date_sk",
    "state_test_runs": "month",
    "state_open_links": "month",
}
#: Tables kept in buckets of a key.
HASHED = {
    "dim_issue": "issue_key",
    "dim_defect": "defect_key",
    "dim_test": "test_key",
    "dim_test_execution": "execution_key",
    "bridge_issue_test": "issue_key",
    "bridge_issue_release": "issue_key",
    "fact_requirement_coverage": "issue_sk",
    "month_of_run": "test_run_id",
    "month_of_link": "test_run_id",
    "month_of_step": "step_result_id",
}
#: Where the rows of a fact's keys are: a narrow table from key to month, in buckets of the key.
LOCATORS = {"fact_test_run": "month_of_run", "fact_defect_link": "month_of_link", "fact_test_step_result": "month_of_step"}
#: Buckets of a new warehouse; a bucket of the largest dimension should be a file or two.
BUCKETS = 32


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, ci: bool = False):
        """``buckets`` is taken for a new warehouse; one that exists keeps its own. With ``ci`` loads take natural keys
        that differ only in case for the same."""
        self.spark = spark
        self.ci = ci
        self.root = root.rstrip("/")
        layout = read_or_none(spark, "buckets INT", f"{self.root}/_layout")
        self.is_new = layout is None
        self.buckets = buckets if layout is None else layout.first()[0]

    def division(self, name: str) -> str | None:
        """Column that names the folder of a row, if the table is divided."""
        return DATED.get(name) or ("bucket" if name in HASHED else None)

    def divided(self, name: str, df: DataFrame) -> DataFrame:
        """Rows in the table's layout, with the bucket they belong to."""
        rows = S.conform(df, name)
        return rows.withColumn("bucket", self.bucket(HASHED[name])) if name in HASHED else rows

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def rows(self, name: str, folder: str | None = None) -> DataFrame:
        """The table with its division, from its own or another folder."""
        layout = S.struct(name)
        if name in HASHED:
            layout = layout.add("bucket", IntegerType())
        found = read_or_none(self.spark, layout, folder or f"{self.root}/{name}")
        return no_rows(self.spark, layout) if found is None else found.select(*layout.fieldNames())

    def table(self, name: str) -> DataFrame:
        return self.rows(name).select(*S.columns(name))

    def begin(self) -> Update:
        return Update(self)

    def star(self) -> Star:
        """All published tables, as of now."""
        return Star({name: (lambda n=name: self.table(n)) for name in S.TABLES})


class Update:
    """Tables as they are published, with what the update has prepared so far in their place."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.folder = f"{warehouse.root}/_prepared/{uuid.uuid4().hex}"
        # per table: the folders that are replaced (None: all) and their new rows
        self._prepared: dict[str, tuple[set | None, DataFrame]] = {}
        # per table: where it was prepared last, and for a divided one which of those folders hold rows and where
        self._last: dict[str, str] = {}
        self._present: dict[str, dict[int, str]] = {}
        # published tables that were looked at, so that their folders are listed once
        self._held: dict[str, DataFrame] = {}
        self.changed: dict[str, tuple[int, int]] = {}

    def _rows(self, name: str, parts: Iterable | None = None) -> DataFrame:
        division = self.warehouse.division(name)
        replaced, new = self._prepared.get(name, (set(), None))
        chosen = (lambda df: df) if parts is None else (lambda df, of=list(parts): df.where(F.col(division).isin(of)))
        if replaced is None:
            return chosen(new)
        if name not in self._held:
            self._held[name] = self.warehouse.rows(name)
        held = self._held[name]
        if new is None:
            return chosen(held)
        return chosen(held.where(~F.col(division).isin(list(replaced)))).unionByName(chosen(new))

    def table(self, name: str, parts: Iterable | None = None) -> DataFrame:
        """The table, or its rows in some folders."""
        return self._rows(name, parts).select(*S.columns(name))

    def star(self) -> Star:
        return Star({name: (lambda n=name: self.table(n)) for name in S.TABLES})

    def parts_of(self, name: str, rows: DataFrame) -> list[int]:
        """Folders of a divided table that the rows belong to; no more than the table has."""
        part = self.warehouse.bucket(HASHED[name]) if name in HASHED else F.col(DATED[name])
        return sorted(r[0] for r in rows.select(part.alias("_part")).distinct().collect() if r[0] is not None)

    def replaced(self, name: str) -> list[int]:
        """Folders of a divided table that the update has prepared."""
        return sorted(self._prepared.get(name, (set(), None))[0])

    def put(self, name: str, df: DataFrame, parts: Iterable | None = None) -> None:
        """Replace a table, or some folders of a divided one, by ``df``."""
        division, folder = self.warehouse.division(name), f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        rows = self.warehouse.divided(name, df)
        self._last[name] = folder
        if not division:
            rows.write.parquet(folder)
            self._prepared[name] = (None, self.warehouse.rows(name, folder))
            return
        rows.hint("rebalance", division).write.partitionBy(division).parquet(folder)
        new = self.warehouse.rows(name, folder)
        present = parts_in(self.spark, folder, division)
        before, earlier = self._prepared.get(name, (set(), None))
        if parts is None:
            parts = parts_in(self.spark, f"{self.warehouse.root}/{name}", division) | before
        now = {*parts, *present}
        self._present[name] = {p: at for p, at in self._present.get(name, {}).items() if p not in now} | dict.fromkeys(present, folder)
        if earlier is not None:
            new = earlier.where(~F.col(division).isin(list(now))).unionByName(new)
        self._prepared[name] = (before | now, new)

    def count_changes(self, name: str, target: DataFrame, updates: DataFrame, keys: Sequence[str], merge: Callable | None = None) -> None:
        """Note how many updates insert and how many update rows of a table; only keys are read."""
        row = upsert.changes(target, updates, keys).first()
        updated = 0 if merge is upsert.insert_absent else row["updated"]
        before = self.changed.get(name, (0, 0))
        self.changed[name] = (before[0] + row["inserted"], before[1] + updated)

    def months_of(self, fact: str, ids: DataFrame) -> DataFrame:
        """``key, month`` of a fact's rows with the given keys (distinct); reads the buckets of those keys alone."""
        locator = LOCATORS[fact]
        key = HASHED[locator]
        return self.table(locator, self.parts_of(locator, ids)).join(ids, key, "left_semi")

    def merge_months(self, name: str, updates: DataFrame, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Merge updates into a fact, rewriting only months they touch.

        Touched are the months of the updates and those that hold a row with the same key, which may have moved; the
        locator tells them, so no other month is read.
        """
        locator = LOCATORS[name]
        key = HASHED[locator]
        ids = updates.select(key).where(F.col(key).isNotNull()).distinct()
        months = {r[0] for r in self.months_of(name, ids).select("month").union(updates.select("month")).distinct().collect()} - {None}
        if not months:
            return
        target = self.table(name, months)
        together(lambda: self.count_changes(name, target, updates, keys), lambda: self.put(name, merge(target, updates), months))
        self._locate(name, ids, months)

    def _locate(self, name: str, ids: DataFrame, months: Iterable[int]) -> None:
        """Note anew in which of the months the rows of some keys are; they are in no others."""
        locator = LOCATORS[name]
        key = HASHED[locator]
        buckets = self.parts_of(locator, ids)
        now = self.table(name, months).join(ids, key, "left_semi").select(key, "month").distinct()
        others = self.table(locator, buckets).join(ids, key, "left_anti")
        self.put(locator, others.unionByName(now), buckets)

    def remove_rows(self, name: str, gone: DataFrame, key: str) -> None:
        """Take the rows with some keys (distinct) out of a fact; only months that hold such rows are rewritten."""
        rows = self.table(name)
        months = [r[0] for r in rows.select(key, "month").join(gone, key, "left_semi").select("month").distinct().collect()]
        if months:
            of_locator = HASHED[LOCATORS[name]]
            ids = sized(cut(self.table(name, months).join(gone, key, "left_semi").select(of_locator).distinct()))
            self.put(name, self.table(name, months).join(gone, key, "left_anti"), months)
            # the published rows name the keys, whichever of them are left
            self._locate_again(name, ids)

    def _locate_again(self, name: str, ids: DataFrame) -> None:
        months = [r[0] for r in self.months_of(name, ids).select("month").distinct().collect()]
        self._locate(name, ids, months)

    def publish(self) -> None:
        """Move everything prepared to the place of what it replaces."""
        if self.warehouse.is_new and self._prepared:
            self.spark.range(1).select(F.lit(self.warehouse.buckets).alias("buckets")).coalesce(1).write.mode("ignore").parquet(f"{self.warehouse.root}/_layout")
            self.warehouse.is_new = False
        together(*[lambda n=name: self._publish(n) for name in self._prepared])
        self._prepared, self._present, self._last, self._held = {}, {}, {}, {}
        remove(self.spark, self.folder)

    def _publish(self, name: str) -> None:
        division, path = self.warehouse.division(name), f"{self.warehouse.root}/{name}"
        if not division:
            move(self.spark, self._last[name], path)
            return
        for part in sorted(self._prepared[name][0]):
            to, present = f"{path}/{division}={part}", self._present[name].get(part)
            if present is None:  # no row is left in it
                remove(self.spark, to)
            else:
                move(self.spark, f"{present}/{division}={part}", to)
        nowhere = f"{division}=__HIVE_DEFAULT_PARTITION__"
        move(self.spark, f"{self._last[name]}/{nowhere}", f"{path}/{nowhere}")
