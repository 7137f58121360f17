"""The whole job: export, raw views, staging, snapshots, models, gold tables, checks."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.enrich import RECONCILED, enrich_lines, reconcile
from millrace.operators.joins import packed, unpacked
from millrace.operators.quality import Watch, report, rule_counts, with_status
from millrace.plans.checks import KEPT_AS, business_rules, declared_checks, raw_with_staged, relations
from millrace.plans.staging import DAY_COLUMNS, STAGED
from millrace.plans.warehouse import MENU_CHECK, RESTAURANT_CHECK, Warehouse
from millrace.session import configure, delete, discard_written, input_bytes, run_together, size_shuffles, written_so_far
from millrace.sources.bronze import Last, day_files, export_table, register_raw, stored_days, with_day, with_parent_day, write_days
from millrace.sources.history import record_snapshot

DIMENSIONS = (
    "dim_customers",
    "dim_customer_addresses",
    "dim_couriers",
    "dim_currencies",
    "dim_date",
    "dim_restaurants",
    "dim_restaurants_backfill",
    "dim_menu_items",
    "dim_menu_items_backfill",
)
# Facts and the day their files are clustered by.
FACTS = {
    "fct_orders": "order_date_utc",
    "fct_order_items": "order_date_utc",
    "fct_refunds": "refund_date_utc",
    "fct_fx_rates": "rate_date_utc",
}
# Facts with the key of a dimension version, which is an md5 text, and the columns that follow from others of a row.
VERSION_KEYS = {"fct_orders": ("restaurant_sk",), "fct_order_items": ("menu_item_sk",), "fct_refunds": ("restaurant_sk",)}
DERIVED = {"fct_orders": (RECONCILED, reconcile)}
# Rows of one order repeat its columns, so they are kept together within a day.
SORTED_BY = {"fct_order_items": "order_id", "fct_refunds": "order_id"}
# The fact with the most rows is written down before it is gathered: else the shuffles of its joins and of the
# gathering, several times the table itself, lie on disk together.
IN_STEPS = ("fct_order_items",)


# Views of the intermediate models.
INTERMEDIATE = {
    "int_orders__items_rollup": "items_rollup",
    "int_orders__status_rollup": "status_rollup",
    "int_orders__delivery_enriched": "delivery_enriched",
    "int_orders__reconciliation": "orders_reconciliation",
    "int_orders__enriched": "orders_enriched",
    "int_order_items__enriched": "order_items_enriched",
    "int_refunds__enriched": "refunds_enriched",
    "int_menu_items__snapshot_source": "menu_items_snapshot_source",
    "int_restaurants__snapshot_source": "restaurants_snapshot_source",
}


def export_bronze(sources: dict[str, DataFrame], base: str, watch: Watch | None = None) -> None:
    """Write all source tables, several at a time: event tables by day, the others whole.

    A source may be any DataFrame, for example one read through JDBC, but must not
    itself read from ``base``, which is overwritten. ``watch`` counts for the raw tables' row checks.
    """

    def export(name: str, df: DataFrame) -> None:
        last = (lambda out: watch.on(out, f"raw_{name}")) if watch else (lambda out: out)
        if name not in DAY_COLUMNS:
            export_table(df, f"{base}/{name}", last)
            return
        ts, day = DAY_COLUMNS[name]
        if name == "order_items":
            dated = with_parent_day(df, sources["orders"], "order_id", ts, day)
        else:
            dated = with_day(df, ts, day)
        write_days(dated, f"{base}/{name}", day, last)

    with day_files(next(iter(sources.values())).sparkSession):
        run_together([lambda name=name, df=df: export(name, df) for name, df in sources.items()])


def take_snapshots(raw: dict[str, DataFrame], base: str, snapshot_ts: str) -> tuple[DataFrame, DataFrame]:
    """Record the current state of menu and restaurants; returns both histories."""
    staged = Warehouse(raw)
    menu, restaurants = staged.menu_items_snapshot_source, staged.restaurants_snapshot_source
    return tuple(
        run_together(
            [
                lambda: record_snapshot(menu, f"{base}/menu_items", "menu_item_id", MENU_CHECK, snapshot_ts),
                lambda: record_snapshot(restaurants, f"{base}/restaurants", "restaurant_id", RESTAURANT_CHECK, snapshot_ts),
            ]
        )
    )


def gather_by_day(df: DataFrame, name: str, step: str | None = None) -> DataFrame:
    """Rows of a fact by day, so that the statistics of a file cover few days and day filters skip files.

    AQE splits a day that is too large for one file. Columns that follow from others do not go through the
    shuffle, and version keys do as bytes. With ``step`` the rows are first written to that path and read
    back, and the shuffles behind them are gone before they are gathered.
    """
    derived, derive = DERIVED.get(name, ((), lambda df: df))
    keys, day = VERSION_KEYS.get(name, ()), FACTS[name]
    narrow = packed(df.drop(*derived), *keys)
    if step:
        export_table(narrow, step)
        narrow = df.sparkSession.read.schema(narrow.schema).parquet(step)
    gathered = narrow.hint("rebalance", F.col(day))
    out = derive(unpacked(gathered, *keys)).select(*df.columns)
    return out.sortWithinPartitions(day, SORTED_BY[name]) if name in SORTED_BY else out


def write_gold(df: DataFrame, base: str, name: str, last: Last = lambda df: df) -> DataFrame:
    """Write one gold table, a fact gathered by day, and read it back."""
    step = f"{base}/{name}.step" if name in IN_STEPS else None
    if name in FACTS:
        df = gather_by_day(df, name, step)
    export_table(df, f"{base}/{name}", last)
    if step:
        delete(df.sparkSession, step)
    return df.sparkSession.read.parquet(f"{base}/{name}")


def run_checks(warehouse: Warehouse) -> DataFrame:
    """All declared checks and the business rules, one row each.

    Row checks of relations that were watched while they were written cost nothing more; those of a
    raw table and its staged form share a scan.
    """
    declared = declared_checks()
    warehouse.prepare()
    counted = warehouse.watch.failures() if warehouse.watch else {}
    both = raw_with_staged(warehouse, [c for c in declared if c not in counted])
    found = report(declared, relations(warehouse, *declared), counted, both)
    rules = rule_counts(business_rules(warehouse)).withColumnsRenamed({"rule": "check_name"})
    return found.unionByName(with_status(rules.withColumn("relation", F.lit("gold"))))


class StoredWarehouse(Warehouse):
    """A warehouse whose shared nodes and gold tables are stored under one folder."""

    def __init__(self, raw: dict[str, DataFrame], base: str, menu_history: DataFrame, restaurant_history: DataFrame, watch: Watch | None = None):
        super().__init__(raw, menu_history, restaurant_history, keep=self.store, watch=watch)
        self.base = base
        self.gold: dict[str, DataFrame] = {}

    def days_of(self, table: str, day: str) -> DataFrame:
        # The raw day column names the directories, and staging takes it as it is.
        raw = DAY_COLUMNS[table][1]
        if not any(f"/{raw}=" in f for f in self.raw[table].inputFiles()):
            return super().days_of(table, day)
        return stored_days(self.raw[table], raw).withColumnRenamed(raw, day)

    @cached_property
    def order_items_enriched(self) -> DataFrame:
        # The stored line fact without its dimension key holds the lines with their order, as the order fact does the orders.
        lines = self.fct_order_items.select(*self.lines_with_order.columns)
        return enrich_lines(lines, self.staged("menu_items"), self.keys_of("order_items"))

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write a node once and let all its readers start from the table.

        The lines with their order have one reader beside the line fact, which starts from that.
        """
        if name == "lines_with_order":
            return df
        gold = name in DIMENSIONS or name in FACTS
        watched = KEPT_AS.get(name, (name,) if gold else ())
        last = (lambda out: self.watch.on(out, *watched)) if self.watch else (lambda out: out)
        if gold:
            self.gold[name] = write_gold(df, f"{self.base}/gold", name, last)
            return self.gold[name]
        path = f"{self.base}/nodes/{name}"
        export_table(df, path, last)
        return df.sparkSession.read.parquet(path)

    def store_gold(self) -> None:
        """Write every dimension and fact that is not stored yet, several at a time."""
        self.prepare()

        def store(name: str) -> None:
            found = getattr(self, name)
            if name not in self.gold:
                # From here on the attribute is the stored table.
                setattr(self, name, self.store(found, name))

        run_together([lambda name=name: store(name) for name in DIMENSIONS])
        run_together([lambda name=name: store(name) for name in FACTS])

    def register_views(self) -> None:
        """A temporary view for every model: staging, intermediate and gold."""
        for table in STAGED:
            self.staged(table).createOrReplaceTempView(f"stg_{table}")
        for view, model in INTERMEDIATE.items():
            getattr(self, model).createOrReplaceTempView(view)
        for name, df in self.gold.items():
            df.createOrReplaceTempView(f"gold_{name}")


def build_gold(
    raw: dict[str, DataFrame], base: str, menu_history: DataFrame, restaurant_history: DataFrame, watch: Watch | None = None
) -> StoredWarehouse:
    """The models over stored raw tables and stored histories; neither exports nor takes a snapshot."""
    warehouse = StoredWarehouse(raw, base, menu_history, restaurant_history, watch or Watch(declared_checks()))
    warehouse.store_gold()
    warehouse.register_views()
    return warehouse


def build(
    spark: SparkSession, sources: dict[str, DataFrame], base: str, snapshot_ts: str
) -> StoredWarehouse:
    """One complete run over ``sources``; ``gold`` of the result holds the gold tables.

    Export, snapshots and models, which ``export_bronze``, ``take_snapshots`` and ``build_gold`` also run
    one by one. Everything is written under ``base``. The histories under ``base/snapshots``
    grow from run to run; all other tables are replaced.
    """
    configure(spark)
    before = written_so_far()
    watch = Watch(declared_checks())
    export_bronze(sources, f"{base}/bronze", watch)
    size_shuffles(spark, input_bytes(spark, f"{base}/bronze"))
    raw = register_raw(spark, f"{base}/bronze", STAGED)
    warehouse = build_gold(raw, base, *take_snapshots(raw, f"{base}/snapshots", snapshot_ts), watch)
    # Intermediate tables outside ``base`` are of no more use: all gold tables are written.
    discard_written(spark, before)
    return warehouse
