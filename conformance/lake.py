"""The layers of the lakehouse over a folder of the given tables, each built on demand."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from conformance.adapter import read_entity
from shelfstrata.operators.conform import conform
from shelfstrata.operators.dedup import columns_behind
from shelfstrata.operators.rules import Relationship
from shelfstrata.plans import intermediate, marts
from shelfstrata.plans.silver import to_silver
from shelfstrata.plans.staging import STAGING, stg_orders
from shelfstrata.schemas import ENTITIES, SILVER_METADATA
from shelfstrata.sources.landing import read_csv, write_csv
from shelfstrata.sources.scratch import scratch_folder
from shelfstrata.sources.tables import read_table, table_path, write_table

#: The models that others are made of, and all models in an order in which they can be built.
MADE_OF = {
    "dim_customer": ("stg_customers",),
    "dim_product": ("stg_products",),
    "dim_stores": ("stg_stores",),
    "fct_sales": ("stg_orders", "stg_order_items", "stg_products"),
    "fct_inventory_snapshot": ("stg_inventory_snapshots", "stg_stores", "stg_products"),
    "mart_daily_retail_kpis": ("fct_sales",),
    "mart_promotion_performance": ("stg_promotions", "fct_sales"),
}
MODELS = (*[f"stg_{entity}" for entity in ENTITIES], *MADE_OF)

#: Whether Spark removes shuffle files at the end of a query; without it they stay until the driver happens to collect garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: What a model reads of those it is made of, whichever of its columns are asked for, and for columns of other names there.
JOINED = {
    "fct_sales": ("order_id", "product_id"),
    "fct_inventory_snapshot": ("store_id", "product_id"),
    "mart_daily_retail_kpis": ("order_date", "channel", *marts.KPI_DISTINCT.values()),
    "mart_promotion_performance": (*intermediate.PROMOTION_COLUMNS, "channel", "order_date"),
}
DERIVED = {
    "stg_orders": {"order_date": ("order_timestamp",)},
    "dim_customer": {"customer_key": ("customer_id",)},
    "dim_product": {"product_key": ("product_id",)},
    "dim_stores": {"store_key": ("store_id",)},
    "fct_sales": {
        "sales_key": ("order_item_id",),
        "estimated_cost_amount": ("quantity", "cost_price"),
        "estimated_margin_amount": ("quantity", "cost_price", "net_amount"),
    },
    "fct_inventory_snapshot": {
        "inventory_snapshot_key": ("inventory_snapshot_id",),
        "store_city": ("city",),
        "store_region": ("region",),
        "stock_retail_value": ("stock_on_hand", "unit_price"),
        "stock_cost_value": ("stock_on_hand", "cost_price"),
    },
    "mart_daily_retail_kpis": {
        "total_units_sold": ("quantity",),
        "gross_revenue": ("gross_amount",),
        "total_discount_amount": ("discount_amount",),
        "net_revenue": ("net_amount",),
        "total_tax_amount": ("tax_amount",),
        "total_estimated_cost_amount": ("estimated_cost_amount",),
        "total_estimated_margin_amount": ("estimated_margin_amount",),
        "estimated_margin_rate": ("estimated_margin_amount", "net_amount"),
        "avg_net_revenue": ("net_amount",),
    },
    "mart_promotion_performance": {
        "promotion_attributed_orders": ("order_id",),
        "promotion_attributed_orders_sold": ("quantity",),
        "promotion_attributed_gross_revenue": ("gross_amount",),
        "promotion_attributed_discount_amount": ("discount_amount",),
        "promotion_attributed_net_revenue": ("net_amount",),
        "promotion_attributed_margin_amount": ("estimated_margin_amount",),
    },
}

#: Facts are stored as the rows they are a projection of: their keys are hashes, which take more room than what is hashed.
ROWS_OF = {"fct_sales": "int_order_revenue", "fct_inventory_snapshot": "int_inventory_position"}


def columns_taken(model: str, columns: Collection[str]) -> set[str]:
    """What the models that ``model`` is made of, or its silver table, must have for some of its columns; names they lack are no matter."""
    derived = DERIVED.get(model, {})
    return {*JOINED.get(model, ()), *[taken for c in columns for taken in derived.get(c, (c,))]}


class Lake:
    """Layers are plans; ``models`` stores what a query reads several times, and models built later read it there."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._kept: dict[str, DataFrame] = {}
        self._read: dict[str, Collection[str]] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, entity: str) -> DataFrame:
        return read_entity(self.spark, self.sf_dir, entity)

    def text(self, entity: str) -> DataFrame:
        """The entity as landed: all columns as text."""
        raw = self.raw(entity)
        return raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])

    def conformed(self, entity: str) -> DataFrame:
        """Typed, duplicates still in."""
        return conform(self.raw(entity), ENTITIES[entity].schema)

    def silver(self, entity: str, counted: str | None = None) -> DataFrame:
        return to_silver(self.raw(entity), entity, counted) if counted else to_silver(self.cut(entity), entity)

    def cut(self, entity: str) -> DataFrame:
        """The entity, before conforming, without the columns that nothing read of its staging model depends on."""
        raw, model, declared = self.raw(entity), f"stg_{entity}", ENTITIES[entity]
        if model not in self._read:
            return raw
        wanted = columns_taken(model, self._read[model])
        behind = columns_behind(declared.column_names, wanted, declared.key, declared.recency)
        return raw.select(*[c for c in raw.columns if c in behind])

    def staged(self, entity: str) -> DataFrame:
        if f"stg_{entity}" in self._kept:
            return self._kept[f"stg_{entity}"]
        return STAGING[entity](self.silver(entity)).drop(*SILVER_METADATA)

    def looked_up(self, entity: str, fact: str) -> DataFrame:
        """A staging model as a fact joins it. If the fact takes nothing of it but the key, the join can only repeat rows. Whether a
        stored model would do that is looked up; if not, it is given as one row per key, and Spark leaves out the join."""
        staged, key = self.staged(entity), ENTITIES[entity].key
        if f"stg_{entity}" not in self._kept or columns_taken(fact, self._read[fact]) & {*staged.columns} - {*key}:
            return staged
        rows = staged.dropna(subset=list(key)).groupBy(*key).count()
        return staged.dropDuplicates(list(key)) if rows.filter("count > 1").isEmpty() else staged

    @property
    def revenue(self) -> DataFrame:
        if "int_order_revenue" in self._kept:
            return self._kept["int_order_revenue"]
        return intermediate.int_order_revenue(
            self.staged("orders"), self.staged("order_items"), self.looked_up("products", "fct_sales")
        )

    @property
    def position(self) -> DataFrame:
        if "int_inventory_position" in self._kept:
            return self._kept["int_inventory_position"]
        return intermediate.int_inventory_position(
            self.staged("inventory_snapshots"),
            self.looked_up("stores", "fct_inventory_snapshot"),
            self.looked_up("products", "fct_inventory_snapshot"),
        )

    @property
    def sales(self) -> DataFrame:
        return marts.fct_sales(self.revenue)

    def related(self, *entities: str) -> dict[str, DataFrame]:
        return {e: self.silver(e) for e in entities or ENTITIES}

    def parents(self, relationships: Sequence[Relationship]) -> dict[tuple[str, str], DataFrame]:
        """Where to read parent keys that silver is unique on: one row per key has the keys of all rows, which take no sort."""
        sides = {(r.parent_table, r.parent_column) for r in relationships}
        return {(e, column): self.conformed(e) for e, column in sides if ENTITIES[e].key == (column,)}

    def from_csv(self, entity: str) -> DataFrame:
        """Silver by the whole path: landed as CSV, read as text, conformed, one row per key."""
        path = write_csv(self.text(entity), scratch_folder(self.spark, f"landing-{entity}"))
        return to_silver(read_csv(self.spark, path), entity)

    def keep(self, name: str, model: DataFrame) -> DataFrame:
        """A model written to the scratch folder and read back; what was shuffled to build it goes."""
        base = scratch_folder(self.spark, "models")
        before = self.spark.conf.get(SHUFFLES_GO, "false")
        self.spark.conf.set(SHUFFLES_GO, "true")
        try:
            write_table(model, table_path(base, name), options={"compression": "zstd"})
        finally:
            self.spark.conf.set(SHUFFLES_GO, before)
        return read_table(self.spark, base, name)

    def store(self, name: str, columns: Collection[str]) -> None:
        """Keep some columns of a model, or of the rows that a fact is a projection of; those not asked for are NULL from then on."""
        rows = ROWS_OF.get(name, name)
        model = {"int_order_revenue": lambda: self.revenue, "int_inventory_position": lambda: self.position}.get(
            rows, lambda: self.model(name)
        )()
        wanted = {*columns, *columns_taken(name, columns)}
        cut = model.select(*[c for c in model.columns if c in (columns if rows == name else wanted)])
        self._kept[rows] = conform(self.keep(rows, cut), model.schema)

    def models(self, read: Mapping[str, Collection[str]], passes: Mapping[str, int]) -> dict[str, DataFrame]:
        """Models cut down to the columns ``read`` of them. What is read several times, counted by ``passes`` and by the models
        made of it, is stored with the columns that these passes and models read; dimensions are projections of what is stored."""
        self._read = {name: set(read.get(name, ())) for name in MODELS}
        for name in reversed(MODELS):
            for given in MADE_OF.get(name, ()) if self._read[name] else ():
                self._read[given] |= columns_taken(name, self._read[name])
        found = {}
        for name in MODELS:
            made_of = [m for m in MADE_OF if self._read[m] and name in MADE_OF[m]]
            several = passes.get(name, 0) + len(made_of) > 1
            if several and (made_of or name in ROWS_OF):
                self.store(name, self._read[name])
            if name in read:
                # Which columns are read is a set; their order is the model's.
                model = self.model(name)
                cut = model.select(*[c for c in model.columns if c in read[name]])
                is_stored = name in self._kept or name in ROWS_OF or name.startswith("dim_")
                found[name] = self.keep(name, cut) if several and not is_stored else cut
        return found

    @property
    def attribution(self) -> DataFrame:
        promotions = self.staged("promotions")
        matched = intermediate.attributed_lines(promotions, self.revenue, self.staged("orders"))
        return intermediate.with_unsold(promotions, self.keep("attributed_lines", matched))

    def model(self, name: str) -> DataFrame:
        """A staging or gold model by name."""
        if name.startswith("stg_"):
            return self.staged(name.removeprefix("stg_"))
        return {
            "dim_customer": lambda: marts.dim_customer(self.staged("customers")),
            "dim_product": lambda: marts.dim_product(self.staged("products")),
            "dim_stores": lambda: marts.dim_stores(self.staged("stores")),
            "fct_sales": lambda: self.sales,
            "fct_inventory_snapshot": lambda: marts.fct_inventory_snapshot(self.position),
            "mart_daily_retail_kpis": lambda: marts.mart_daily_retail_kpis(self.sales),
            "mart_promotion_performance": lambda: marts.mart_promotion_performance(
                # Days of headers not yet deduplicated cover those of all lines, and are read without a shuffle.
                self.staged("promotions"), self.sales, stg_orders(self.conformed("orders"))
            ),
        }[name]()
