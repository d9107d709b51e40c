"""The given tables in the roles that the operators expect.

Two families of sessions exist.  *Web*: one session per user and day of ``events``, which
covers one month, has three channels, and often several purchases in a session.  *Visits*:
one session per row of ``orders`` with its order lines as the purchases, which covers
seven years; an order without lines is a visit that did not convert.  The shop proper is ``orders`` with ``lineitem`` as its items, of which the
returned ones carry a refund; ``part`` is the product table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..operators import asof
from ..sources import tables
from ..sources.schemas import SCHEMAS

# An item row has no single-column id: these columns identify it.
ITEM_KEY = ("order_id", "line_no", "product_id", "supplier_id", "shipped_at")

# Units of base currency per unit of local currency, and the day each was taken.
RATES = (
    ("AFRICA", "0.0543", "2001-01-01"),
    ("AFRICA", "0.0561", "2001-07-01"),
    ("AMERICA", "1.0000", "2001-01-01"),
    ("ASIA", "0.0087", "2001-01-01"),
    ("ASIA", "0.0091", "2001-07-01"),
    ("EUROPE", "1.0845", "2001-01-01"),
    ("MIDDLE EAST", "0.2723", "2001-01-01"),
    ("MIDDLE EAST", "0.2801", "2002-01-01"),
)


def _session_id() -> Column:
    return (F.col("user_id") * 1000000 + F.unix_date("day")).alias("website_session_id")


def _device(user: str) -> Column:
    return F.when(F.col(user) % 10 < 7, "desktop").otherwise("mobile").alias("device_type")


def _refund_amount() -> Column:
    """What a return pays back: the price net of its discount, rounded to cents, so it differs from the price at times."""
    net = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return F.round(net, 2).cast("decimal(18,2)")


class Roles:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = tables.parquet(self.spark, self.folder, name)
        return self._tables[name]

    # --- web -----------------------------------------------------------------

    @cached_property
    def _events(self) -> DataFrame:
        return self.table("events").withColumn("day", F.col("ts").cast("date"))

    @cached_property
    def web_sessions(self) -> DataFrame:
        """Two folds: events to (user, day), then a window over one user's days."""
        k = F.get_json_object("props", "$.k").cast("int")
        days = self._events.groupBy("user_id", "day").agg(
            F.min("ts").alias("created_at"), F.min_by(k, "event_id").alias("k0")
        )
        first_day = F.min("day").over(Window.partitionBy("user_id"))
        k0 = F.col("k0")
        return days.withColumn("first_day", first_day).select(
            _session_id(),
            "created_at",
            "user_id",
            (F.col("day") > F.col("first_day")).cast("int").alias("is_repeat_session"),
            F.when(k0 < 60, "search_a").when(k0 < 80, "search_b").alias("utm_source"),
            F.when(k0 < 15, "brand").when(k0 < 70, "nonbrand").when(k0 < 80, "pilot").alias("utm_campaign"),
            F.when(k0 < 90, "ref").alias("http_referer"),
            _device("user_id"),
        )

    @cached_property
    def web_pageviews(self) -> DataFrame:
        kind, even = F.col("event_type"), F.col("event_id") % 2 == 0
        url = (
            F.when(kind == "view", "/products")
            .when(kind == "click", "/the-item")
            .when((kind == "signup") & even, "/cart")
            .when(kind == "signup", "/shipping")
            .when((kind == "error") & even, "/billing")
            .when(kind == "error", "/billing-2")
            .when(kind == "purchase", "/thank-you-for-your-order")
        )
        return self._events.select(
            F.col("event_id").alias("website_pageview_id"),
            F.col("ts").alias("created_at"),
            _session_id(),
            url.alias("pageview_url"),
        )

    @cached_property
    def web_orders(self) -> DataFrame:
        return self._events.where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("order_id"),
            F.col("ts").alias("created_at"),
            _session_id(),
            "user_id",
            F.col("value").alias("price_usd"),
        )

    # --- visits --------------------------------------------------------------

    @cached_property
    def visits(self) -> DataFrame:
        campaign = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
        return self.table("orders").select(
            F.col("o_orderkey").alias("website_session_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_custkey").alias("user_id"),
            campaign.alias("utm_campaign"),
            _device("o_custkey"),
        )

    @cached_property
    def visit_orders(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("website_session_id"),
            F.col("l_extendedprice").alias("price_usd"),
        )

    # --- shop ----------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_totalprice").alias("price_usd"),
        )

    @cached_property
    def orders_with_items(self) -> DataFrame:
        per_order = self.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            exact.rows().alias("n")
        )
        return self.orders.join(per_order, "order_id", "left").withColumn(
            "items_purchased", F.coalesce("n", F.lit(0))
        ).drop("n")

    def _item_key(self) -> list[Column]:
        return [
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_shipdate").alias("shipped_at"),
        ]

    @cached_property
    def items(self) -> DataFrame:
        return self.table("lineitem").select(
            *self._item_key(),
            (F.col("l_linenumber") == 1).cast("int").alias("is_primary_item"),
            F.col("l_extendedprice").alias("price_usd"),
        )

    @cached_property
    def refunds(self) -> DataFrame:
        return self.table("lineitem").where(F.col("l_returnflag") == "R").select(
            *self._item_key(),
            F.col("l_shipdate").alias("created_at"),
            _refund_amount().alias("refund_amount_usd"),
        )

    @cached_property
    def item_facts(self) -> DataFrame:
        """Items with their refund beside them.

        The line carries its return flag, so where refunds need not be a table of their own
        this is what ``returns.with_refunds`` gives, without the join.
        """
        returned = F.col("l_returnflag") == "R"
        price = F.col("l_extendedprice")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            (F.col("l_linenumber") == 1).cast("int").alias("is_primary_item"),
            price.alias("price_usd"),
            F.when(returned, 1).alias("refunded"),
            F.when(returned, _refund_amount()).alias("refund_amount_usd"),
        )

    @cached_property
    def products(self) -> DataFrame:
        """Named by brand; brand number n launched 80 n days after 1 June 1995."""
        number = F.substring_index("p_brand", "#", -1).cast("int")
        launched = F.date_add(F.lit("1995-06-01").cast("date"), number * 80)
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            launched.cast("timestamp_ntz").alias("created_at"),
            F.col("p_brand").alias("product_name"),
            F.col("p_type").alias("product_type"),
        )

    @cached_property
    def products_by_type(self) -> DataFrame:
        return self.products.select("product_id", F.col("product_type").alias("product_name"))

    # --- listings and trips --------------------------------------------------

    @cached_property
    def rates(self) -> DataFrame:
        rows = ", ".join(f"('{c}', {rate}BD, DATE '{day}')" for c, rate, day in RATES)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS rates(currency, rate, taken_on)")

    @cached_property
    def rate_history(self) -> DataFrame:
        """A rate of each currency for every quarter from July 1995, the first year of orders being half over, to 2000."""
        first = [f"('{c}', {rate}BD)" for c, rate in {c: rate for c, rate, _ in reversed(RATES)}.items()]
        base = self.spark.sql(f"SELECT * FROM VALUES {', '.join(first)} AS rates(currency, rate)")
        return asof.drifting_rates(base, "1995-07-01", "2000-10-01")

    @cached_property
    def dated_orders(self) -> DataFrame:
        """Orders in the currency of their customer's region, with their day."""
        places = self.listings.select(F.col("listing_id").alias("user_id"), "currency")
        return self.orders.join(places, "user_id").select("order_id", "currency", F.col("created_at").cast("date").alias("day"), "price_usd")

    @cached_property
    def listings(self) -> DataFrame:
        """A customer is a listing: its nation the city, its region the currency area.

        A balance of zero or less is no price, so such a listing counts but is unpriced.
        """
        price = exact.money(F.col("c_acctbal"))
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("currency"))
        cities = self.table("nation").join(region, "n_regionkey").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"), "currency"
        )
        return self.table("customer").join(cities, "c_nationkey").select(
            F.col("c_custkey").alias("listing_id"),
            "city",
            "currency",
            F.when(price > 0, price).alias("price"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").alias("listing_id"), F.col("o_orderdate").alias("created_at")
        )

    @cached_property
    def zones(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone"))

    @cached_property
    def trips(self) -> DataFrame:
        """A shipped line: picked up where its supplier is, on the day it ships."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_shipdate").alias("picked_up_at"),
            F.col("l_quantity").alias("distance"),
        )

    def _dropoffs(self) -> DataFrame:
        """Each order with the zone of its customer."""
        customer = self.table("customer").select("c_custkey", F.col("c_nationkey").alias("dropoff_zone_id"))
        orders = self.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("c_custkey"))
        return orders.join(customer, "c_custkey").select("order_id", "dropoff_zone_id")

    def _pickups(self) -> DataFrame:
        """Each supplier with its zone."""
        return self.table("supplier").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_nationkey").alias("pickup_zone_id")
        )

    @cached_property
    def pickup_counts(self) -> DataFrame:
        """Trips per pick-up zone id.  Lines are folded by supplier first, so a busy supplier joins as one row."""
        folded = self.trips.groupBy("supplier_id").agg(exact.rows().alias("trips"))
        return folded.join(self._pickups(), "supplier_id").select(F.col("pickup_zone_id").alias("zone_id"), "trips")

    @cached_property
    def dropoff_counts(self) -> DataFrame:
        """Trips per drop-off zone id.  Lines are folded by order first, so a huge order joins as one row."""
        folded = self.trips.groupBy("order_id").agg(exact.rows().alias("trips"))
        return folded.join(self._dropoffs(), "order_id").select(F.col("dropoff_zone_id").alias("zone_id"), "trips")

    @cached_property
    def pair_counts(self) -> DataFrame:
        """Trips per pair of zone ids.

        Lines are shuffled once, folded by order and supplier; the next fold, by supplier and drop-off zone,
        leaves at most suppliers times zones rows for the join to suppliers.
        """
        lines = self.trips.groupBy("order_id", "supplier_id").agg(exact.rows().alias("trips"))
        placed = lines.join(self._dropoffs(), "order_id").groupBy("supplier_id", "dropoff_zone_id").agg(F.sum("trips").alias("trips"))
        return placed.join(self._pickups(), "supplier_id").select("pickup_zone_id", "dropoff_zone_id", "trips")

    # --- the declared shop -----------------------------------------------------

    @cached_property
    def declared_tables(self) -> dict[str, DataFrame]:
        """The six tables of the shop, column for column as ``sources.schemas`` declares them."""
        item = F.col("order_id") * 10 + F.col("line_no")
        primary = self.items.where("is_primary_item = 1").groupBy("order_id").agg(F.min("product_id").alias("primary_product_id"))
        ordered = self.orders_with_items.join(primary, "order_id", "left")
        items = self.items.join(self.orders.select("order_id", "created_at"), "order_id")
        given = {
            "products": self.products,
            "website_sessions": self.web_sessions.withColumn("utm_content", F.col("utm_campaign")),
            "website_pageviews": self.web_pageviews,
            "orders": ordered.withColumn("website_session_id", F.col("order_id")).withColumn("cogs_usd", F.col("price_usd") / 2),
            "order_items": items.withColumn("order_item_id", item).withColumn("cogs_usd", F.col("price_usd") / 2),
            "order_item_refunds": self.refunds.withColumn("order_item_id", item).withColumn("order_item_refund_id", item),
        }
        return {name: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields]) for name, df in given.items()}

    # --- other spellings -----------------------------------------------------

    @staticmethod
    def _respelled(text: Column, n: Column) -> Column:
        """The same word in capitals, with an accent, or as it is, by turns."""
        return F.when(n % 4 == 1, F.upper(text)).when(n % 4 == 2, F.translate(text, "ao", "\u00e1\u00f6")).otherwise(text)

    @cached_property
    def mixed_visits(self) -> DataFrame:
        """Visits whose campaign is spelled in three ways."""
        return self.visits.withColumn("utm_campaign", self._respelled(F.lower("utm_campaign"), F.col("website_session_id")))

    @cached_property
    def mixed_pageviews(self) -> DataFrame:
        return self.web_pageviews.withColumn("pageview_url", self._respelled(F.col("pageview_url"), F.col("website_pageview_id")))

    @cached_property
    def mixed_products(self) -> DataFrame:
        return self.products.withColumn("product_name", self._respelled(F.lower("product_name"), F.col("product_id")))
