"""A hand-made shop that carries the edge rows."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tillwise.sources.schemas import SCHEMAS


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M" if " " in text else "%Y-%m-%d")


def table(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def sessions(spark):
    #        id, created, user, repeat, source, campaign, content, device, referer
    return table(
        spark,
        "website_sessions",
        [
            (1, at("2013-03-19 10:00"), 10, 0, "search", "brand", None, "desktop", "ref"),
            (2, at("2013-03-20 10:00"), 11, 0, "search", "nonbrand", None, "mobile", "ref"),
            (3, at("2014-01-31 23:59"), 10, 1, None, None, None, "desktop", "ref"),  # orders after midnight
            (4, at("2014-02-01 09:00"), 12, 0, None, None, None, "mobile", None),  # never orders, no pageview
            (5, at("2014-03-19 23:59"), 13, 0, "search", "brand", None, "desktop", "ref"),  # orders twice
            (6, at("2014-12-01 08:00"), 14, 0, "search", "nonbrand", None, "mobile", "ref"),
        ],
    )


def money(x):
    return Decimal(x)


def orders(spark):
    #        id, created, session, user, product, items, price, cogs
    return table(
        spark,
        "orders",
        [
            (101, at("2013-03-19 10:30"), 1, 10, 1, 1, money("49.99"), money("19.49")),
            (102, at("2014-02-01 00:05"), 3, 10, 1, 2, money("109.98"), money("40.00")),
            (103, at("2014-03-19 23:59"), 5, 13, 2, 1, money("59.99"), money("22.00")),
            (104, at("2014-03-20 00:10"), 5, 13, 1, 1, money("49.99"), money("19.49")),
        ],
    )


def products(spark):
    return table(
        spark,
        "products",
        [(1, at("2012-03-19 08:00"), "Alpha"), (2, at("2014-01-06 13:00"), "Beta"), (3, at("2014-03-01"), "Gamma")],
    )


def items(spark):
    #        id, created, order, product, primary, price, cogs
    return table(
        spark,
        "order_items",
        [
            (1001, at("2013-03-19 10:30"), 101, 1, 1, money("49.99"), money("19.49")),
            (1002, at("2014-02-01 00:05"), 102, 1, 1, money("49.99"), money("19.49")),
            (1003, at("2014-02-01 00:05"), 102, 2, 0, money("59.99"), money("22.00")),
            (1004, at("2014-03-19 23:59"), 103, 2, 1, money("59.99"), money("22.00")),
            (1005, at("2014-03-20 00:10"), 104, 1, 1, money("49.99"), money("19.49")),
        ],
    )


def refunds(spark):
    #        id, created, item, order, amount
    return table(
        spark,
        "order_item_refunds",
        [
            (1, at("2013-04-02 09:00"), 1001, 101, money("20.00")),  # two refunds of one item
            (2, at("2013-04-03 09:00"), 1001, 101, money("29.99")),
            (3, at("2014-03-21 00:01"), 1005, 104, money("49.99")),
        ],
    )


def pageviews(spark):
    urls = [
        (1, "/home"), (1, "/products"), (1, "/products"), (1, "/the-alpha"), (1, "/cart"), (1, "/shipping"),
        (1, "/billing-2"), (1, "/thank-you-for-your-order"),
        (2, "/lander-1"), (2, "/products"),
        (3, "/home"), (3, "/The-Beta"), (3, "/billing"), (3, "/thank-you-for-your-order"),
        (5, "/thank-you-for-your-order"), (5, "/billing"),
        (6, "/home"),
    ]
    return table(
        spark,
        "website_pageviews",
        [(i, at("2014-01-01"), s, u) for i, (s, u) in enumerate(urls)],
    )
