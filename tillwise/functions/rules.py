"""Business rules shared by several operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def channel(source: str = "utm_source", referer: str = "http_referer") -> Column:
    """Last-touch channel: tagged traffic is paid, the rest splits on the referer."""
    return (
        F.when(F.col(source).isNotNull(), "Paid")
        .when(F.col(referer).isNotNull(), "Organic Search")
        .otherwise("Direct")
    )


@dataclass(frozen=True)
class Step:
    """A funnel step: an output column name and the test a page URL must pass."""

    name: str
    matches: Callable[[Column], Column]


# The page URLs of the shop's checkout path, in order.
CHECKOUT_STEPS: tuple[Step, ...] = (
    Step("reached_products", lambda url: url == "/products"),
    Step("reached_product_detail", lambda url: url.startswith("/the-")),
    Step("reached_cart", lambda url: url == "/cart"),
    Step("reached_shipping", lambda url: url == "/shipping"),
    Step("reached_billing", lambda url: url.isin("/billing", "/billing-2")),
    Step("reached_thankyou", lambda url: url == "/thank-you-for-your-order"),
)
