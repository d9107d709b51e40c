from . import effects, funnel, market, products, quality, quantiles, returns, series, sessions, trips, users

__all__ = [
    "effects",
    "funnel",
    "market",
    "products",
    "quality",
    "quantiles",
    "returns",
    "series",
    "sessions",
    "trips",
    "users",
]
