"""The warehouse as a graph of lazy DataFrames over ten source tables.

A table is planned once per warehouse and shared by whatever is built on it.
Nothing is computed or kept unless the caller writes it (see ``sources.files``)
or replaces a table by a written one with ``use``.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import acquisition, dimensions, facts, fulfilment, gates, planning, revenue, staging
from .session import shared_table

SOURCES = (
    "users",
    "products",
    "orders",
    "order_items",
    "events",
    "inventory_events",
    "distribution_centers",
    "country_master",
    "fx_budget_rates",
    "plan_submissions",
)
ITEM_PRODUCT_COLUMNS = ("category", "department", "brand")
ITEM_CUSTOMER_COLUMNS = ("country", "age_band")


@dataclass(frozen=True)
class Derived:
    """A source made from tables of the warehouse that holds it."""

    build: Callable[[Warehouse], DataFrame]


class _Sources(dict):
    """Source tables; one given as a function is opened on first use."""

    def __init__(self, tables, warehouse: Warehouse):
        super().__init__(tables)
        self._warehouse = warehouse
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        table = super().__getitem__(name)
        if isinstance(table, DataFrame):
            return table
        opened = (lambda: table.build(self._warehouse)) if isinstance(table, Derived) else table
        return self._warehouse._planned(f"raw:{name}", self._open, name, opened)

    def close(self, name: str) -> None:
        self._open.pop(name, None)


def _only(df: DataFrame, columns: Collection[str], rows: DataFrame | None = None) -> DataFrame:
    """The same rows and schema with all other columns null; ``rows`` may stand in for ``df`` with just the columns."""
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")
    source = df if rows is None else rows
    return source.select(*[F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def _written(df: DataFrame, columns: Collection[str], label: str) -> DataFrame:
    """``_only`` of a table written once.

    Just the columns are in the files: null ones there would have a share in
    Spark's size of the few that a branch reads, and a fact of millions of rows
    would pass for small enough to be broadcast.
    """
    wanted = _only(df, columns).select(*[c for c in df.columns if c in columns])
    return _only(df, columns, shared_table(wanted, label))


class Warehouse:
    def __init__(
        self,
        raw: Mapping[str, DataFrame | Callable[[], DataFrame] | Derived],
        comparisons: Sequence[planning.Comparison] = (),
    ):
        missing = [t for t in SOURCES if t not in raw]
        if missing:
            raise ValueError(f"missing source tables: {', '.join(missing)}")
        self.raw = _Sources(raw, self)
        self.comparisons = tuple(comparisons)
        self._tables: dict[str, DataFrame] = {}
        self._written: set[str] = set()
        self._building: list[str] = []
        self._users: dict[str, set[str]] = {}

    def use(self, name: str, df: DataFrame) -> None:
        """Stand a written table in for a planned one.

        Plans made on the old one are dropped and made anew when they are next
        asked for; tables that were themselves replaced stay.
        """
        self._tables[name] = df
        self._written.add(name)
        stale = list(self._users.pop(name, ()))
        while stale:
            user = stale.pop()
            if user in self._written:
                continue
            if user.startswith("raw:"):
                self.raw.close(user.removeprefix("raw:"))
            self._tables.pop(user, None)
            stale += self._users.pop(user, ())

    def written_once(self, tables: Mapping[str, Collection[str]]) -> Warehouse:
        """A warehouse over the same sources in which the named sources or tables are written to the shared folder.

        For a result with many branches on one table. Every branch reads other
        columns, so Spark shares no shuffle between them and joins anew for each;
        here the joins are made once and the branches read columns of the files.
        Only the given columns are carried through them; the others are null, so
        a result must name all that it reads. Sources not in this warehouse are
        passed over.
        """
        own = Warehouse(dict(dict.items(self.raw)), self.comparisons)
        for name in self._written:
            own.use(name, self._tables[name])
        for name, columns in tables.items():
            if name in BUILDERS and name not in own._written:
                own.use(name, _written(own.table(name), columns, name))
            elif name in own.raw:
                own.raw[name] = _written(own.raw[name], columns, name)
        return own

    def _planned(self, node: str, made: dict[str, DataFrame], name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """``made[name]``, built once; notes which plan asks for it."""
        if self._building:
            self._users.setdefault(node, set()).add(self._building[-1])
        if name not in made:
            self._building.append(node)
            try:
                made[name] = build()
            finally:
                self._building.pop()
        return made[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BUILDERS:
            raise AttributeError(name)
        return self._planned(name, self._tables, name, lambda: BUILDERS[name](self))

    def source_gate(self, *only: str) -> DataFrame:
        return gates.source_gate(self.raw, only or None)

    def warehouse_gate(self, *only: str) -> DataFrame:
        return gates.warehouse_gate(
            self.stg_users,
            self.stg_orders,
            self.stg_order_items,
            self.stg_products,
            self.stg_events,
            self.stg_sessions,
            self.fact_order_item,
            self.fact_session,
            self.sales_monthly,
            only or None,
        )

    def commercial_gate(self, *only: str) -> DataFrame:
        return gates.commercial_gate(
            self.stg_plan_submissions,
            self.fact_plan,
            self.wide_order_item,
            self.actual_country_month,
            self.price_volume_mix,
            self.commercial_scorecard,
            only or None,
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


BUILDERS = {
    # typed sources
    "stg_users": lambda w: staging.stage_users(w.raw["users"]),
    "stg_products": lambda w: staging.stage_products(w.raw["products"]),
    "stg_orders": lambda w: staging.stage_orders(w.raw["orders"]),
    "stg_order_items": lambda w: staging.stage_order_items(w.raw["order_items"]),
    "stg_events": lambda w: staging.stage_events(w.raw["events"]),
    "stg_sessions": lambda w: staging.reconstruct_sessions(w.stg_events),
    "stg_inventory_events": lambda w: staging.stage_inventory(w.raw["inventory_events"]),
    "stg_distribution_centers": lambda w: staging.stage_distribution_centers(w.raw["distribution_centers"]),
    "stg_plan_submissions": lambda w: staging.stage_plan(
        w.raw["plan_submissions"], w.dim_country, w.raw["fx_budget_rates"]
    ),
    # dimensions
    "date_bounds": lambda w: dimensions.date_bounds(w.stg_events, w.stg_order_items, w.stg_inventory_events),
    "dim_date": lambda w: dimensions.dim_date(w.date_bounds),
    "dim_month": lambda w: dimensions.dim_month(w.dim_date),
    "dim_customer": lambda w: dimensions.dim_customer(w.stg_users),
    "dim_product": lambda w: dimensions.dim_product(w.stg_products),
    "dim_distribution_center": lambda w: dimensions.dim_distribution_center(w.stg_distribution_centers),
    "dim_session_traffic_source": lambda w: dimensions.dim_session_traffic_source(w.stg_sessions),
    "dim_acquisition_source": lambda w: dimensions.dim_acquisition_source(w.stg_users),
    "dim_country": lambda w: dimensions.dim_country(w.raw["country_master"]),
    "dim_market": lambda w: dimensions.dim_market(w.dim_country),
    # facts
    "fact_order": lambda w: facts.fact_order(w.stg_orders, w.dim_customer),
    "wide_order_item": lambda w: facts.fact_order_item(
        w.stg_order_items, w.dim_product, w.dim_customer, ITEM_PRODUCT_COLUMNS, ITEM_CUSTOMER_COLUMNS
    ),
    "fact_order_item": lambda w: w.wide_order_item.drop(*ITEM_PRODUCT_COLUMNS, *ITEM_CUSTOMER_COLUMNS),
    "fact_session": lambda w: facts.fact_session(w.stg_sessions, w.dim_customer),
    "fact_inventory": lambda w: facts.fact_inventory(
        w.stg_inventory_events, facts.latest_date(w.stg_events, "created_at")
    ),
    "fact_plan": lambda w: facts.fact_plan(w.stg_plan_submissions),
    "plan_rejects": lambda w: facts.plan_rejects(w.stg_plan_submissions),
    # acquisition and funnel
    "funnel_stage_channel": lambda w: acquisition.funnel_stage(w.fact_session),
    "funnel_monthly_channel": lambda w: acquisition.funnel_monthly(w.fact_session),
    "cart_abandonment_segments": lambda w: acquisition.cart_abandonment_segments(w.fact_session),
    "channel_quality": lambda w: acquisition.channel_quality(w.fact_session),
    "acquisition_source_value": lambda w: acquisition.acquisition_source_value(w.wide_order_item),
    # revenue and customers
    "sales_monthly": lambda w: revenue.sales_monthly(w.wide_order_item, w.dim_date),
    "product_performance_category": lambda w: revenue.product_performance(w.wide_order_item, w.dim_product),
    "product_performance_brand": lambda w: revenue.product_performance_brand(w.wide_order_item, w.dim_product),
    "geography_performance_country": lambda w: revenue.geography_performance(
        w.wide_order_item, w.dim_customer, w.dim_country
    ),
    "customer_360": lambda w: revenue.customer_360(w.wide_order_item, w.dim_customer),
    "cohort_retention": lambda w: revenue.cohort_retention(w.wide_order_item),
    "executive_snapshot": lambda w: revenue.executive_snapshot(w.wide_order_item, w.fact_session, w.customer_360),
    # operations and inventory
    "operations_monthly": lambda w: fulfilment.operations_monthly(w.wide_order_item, w.dim_date),
    "delivery_performance_dc": lambda w: fulfilment.delivery_performance(
        w.wide_order_item, w.dim_distribution_center
    ),
    "return_risk_segments": lambda w: fulfilment.return_risk_segments(
        w.wide_order_item, w.dim_product, w.dim_customer
    ),
    "inventory_performance": lambda w: fulfilment.inventory_performance(
        w.fact_inventory, w.dim_product, w.dim_distribution_center
    ),
    # planning
    "actual_country_month": lambda w: planning.actual_country_month(
        w.wide_order_item, w.dim_customer, w.dim_country, w.dim_date
    ),
    "plan_vs_actual_monthly": lambda w: planning.plan_vs_actual_monthly(w.actual_country_month, w.fact_plan),
    "plan_vs_actual_region": lambda w: planning.plan_vs_actual_region(w.plan_vs_actual_monthly),
    "price_volume_mix": lambda w: planning.price_volume_mix(w.wide_order_item, w.dim_product, w.comparisons),
    "commercial_scorecard": lambda w: planning.commercial_scorecard(w.sales_monthly, w.fact_plan),
    # gates and reconciliation
    "raw_test_results": lambda w: w.source_gate(),
    "test_results": lambda w: w.warehouse_gate(),
    "plan_validation": lambda w: w.commercial_gate(),
    "metric_reconciliation": lambda w: gates.metric_reconciliation(
        w.raw["orders"], w.raw["order_items"], w.stg_events, w.stg_order_items, w.fact_order, w.fact_order_item,
        w.fact_session,
    ),
    "reconciliation_statement": lambda w: gates.reconciliation_statement(
        w.raw["order_items"], w.stg_order_items, w.fact_order_item, w.actual_country_month,
        w.raw["plan_submissions"], w.stg_plan_submissions, w.plan_rejects, w.fact_plan,
    ),
}
