"""Least squares over a table: what each attribute adds to a price when all are looked at together.

One fold of the rows gives the sums of products of all columns (the Gram matrix); its size follows the number of columns, not of rows.
The normal equations are solved on the driver.  A category becomes a column per level but one, its base; a column that
others already determine is named and left out, so its effect is not guessed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of the model at most: the matrix has the square of it and is solved on the driver.
MAX_COLUMNS = 500
INTERCEPT = "(intercept)"


@dataclass(frozen=True)
class Model:
    """``coefficients`` by (attribute, level); ``left_out`` are columns that others determine; rows counted and share of variance explained."""

    coefficients: dict[tuple[str, str | None], float]
    bases: dict[str, str]
    left_out: list[tuple[str, str | None]]
    n: int
    r_squared: float | None


def levels(rows: DataFrame, categories: Sequence[str], most: int = MAX_COLUMNS) -> dict[str, list[str]]:
    """The levels of each category, in order; more than ``most`` in all end it."""
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("level")) for c in categories])
    found = rows.select(F.inline(pairs)).where("level IS NOT NULL").distinct().limit(most + 1).collect() if categories else []
    if len(found) > most:
        raise ValueError(f"more than {most} levels: fold the rare ones into one first")
    out: dict[str, list[str]] = {c: [] for c in categories}
    for r in sorted(found):
        out[r["attribute"]].append(r["level"])
    return out


def least_squares(rows: DataFrame, target: str, numeric: Sequence[str] = (), categories: Sequence[str] = (), bases: Mapping[str, str] | None = None) -> Model:
    """Fit ``target`` on an intercept, the numeric columns and the levels of the categories.

    Rows with a NULL in any of these columns are left out.  The base of a category is its first level, or the one given.  A row is a short list of
    (column, value), and only products of these are summed, so many levels cost a row no more than few.
    """
    used = [target, *numeric, *categories]
    whole = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in used)).select(*used)
    known = levels(whole, categories)
    base = {c: (bases or {}).get(c, ls[0] if ls else "") for c, ls in known.items()}
    names: list[tuple[str, str | None]] = [(INTERCEPT, None), *[(c, None) for c in numeric], *[(c, v) for c, ls in known.items() for v in ls if v != base[c]]]
    if len(names) > MAX_COLUMNS:
        raise ValueError(f"{len(names)} columns are more than {MAX_COLUMNS}")
    number = {name: i for i, name in enumerate(names)}
    last = len(names)
    entry = lambda i, v: F.struct(i.cast("int").alias("i"), v.cast("double").alias("v"))
    entries = [entry(F.lit(0), F.lit(1.0)), entry(F.lit(last), F.col(target)), *[entry(F.lit(number[c, None]), F.col(c)) for c in numeric]]
    for c in categories:
        at = F.create_map(*[F.lit(x) for v in known[c] for x in (v, number.get((c, v), -1))]) if known[c] else F.lit(None)
        entries.append(entry(F.try_element_at(at, F.col(c).cast("string")) if known[c] else F.lit(-1), F.lit(1.0)))
    row = whole.select(F.filter(F.array(*entries), lambda e: e["i"] >= 0).alias("e"))
    pairs = row.select("e", F.explode("e").alias("a")).select("a", F.explode("e").alias("b")).where("a.i <= b.i")
    sums = pairs.groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(F.sum(F.col("a.v") * F.col("b.v")).alias("s")).collect()  # a number per pair of columns
    g = np.zeros((last + 1, last + 1))
    for r in sums:
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["s"]
    return _solved(g, names, base)


def _solved(g: np.ndarray, names: list[tuple[str, str | None]], base: dict[str, str]) -> Model:
    last = len(names)
    n = int(round(g[0, 0]))
    if not n:
        return Model({}, base, [], 0, None)
    # centred sums: columns far from zero would lose digits otherwise
    mean = g[0] / n
    c = g - n * np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(c), 0))
    taken: list[int] = []
    left_out = []
    for i in range(1, last):  # a column is taken if what those before it leave of it is not nothing
        if scale[i] <= 1e-12 * np.sqrt(g[i, i]) or scale[i] == 0:
            left_out.append(names[i])
            continue
        if taken:
            a = c[np.ix_(taken, taken)] / np.outer(scale[taken], scale[taken])
            b = c[taken, i] / (scale[taken] * scale[i])
            if 1 - b @ np.linalg.solve(a, b) < 1e-9:
                left_out.append(names[i])
                continue
        taken.append(i)
    beta = np.zeros(0)
    if taken:
        a = c[np.ix_(taken, taken)] / np.outer(scale[taken], scale[taken])
        beta = np.linalg.solve(a, c[taken, last] / scale[taken]) / scale[taken]
    out = {names[0]: float(mean[last] - mean[taken] @ beta)} | {names[i]: float(v) for i, v in zip(taken, beta)}
    explained = float(c[taken, last] @ beta / c[last, last]) if c[last, last] > 0 else None
    return Model(out, base, left_out, n, explained)


def as_rows(model: Model, spark) -> DataFrame:
    """(attribute, level, effect, n, r_squared): a row per column of the model; bases have effect 0, columns left out NULL."""
    data = [(a, v, e) for (a, v), e in model.coefficients.items()] + [(a, v, 0.0) for a, v in model.bases.items()] + [(a, v, None) for a, v in model.left_out]
    told = [F.struct(F.lit(a).alias("attribute"), F.lit(v).cast("string").alias("level"), F.lit(e).cast("double").alias("effect")) for a, v, e in data]
    fit = (F.lit(model.n).cast("long").alias("n"), F.lit(model.r_squared).cast("double").alias("r_squared"))
    return spark.range(1).select(F.inline(F.array(*told)), *fit) if told else spark.range(0).select(*[F.lit(None).cast(k).alias(c) for c, k in (("attribute", "string"), ("level", "string"), ("effect", "double"))], *fit)
