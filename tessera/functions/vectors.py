"""Column expressions over points stored as ``ARRAY<DOUBLE>``.

Everything here is a plain Catalyst expression, so it runs JVM-side. When the
dimension is known the distance is unrolled into ``sum((a[i]-b[i])^2)``, which
whole-stage codegen compiles; otherwise the higher-order form
``aggregate(zip_with(...))`` is used (interpreted, same value, same summation
order).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this many scalar terms an unrolled expression is replaced by the
# higher-order form, to stay under the JVM method-size limits of codegen.
UNROLL_LIMIT = 4096


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def checked_point(col: str | Column = "v") -> Column:
    """The vector itself; raises on a NULL point and on a NULL or NaN coordinate, at any dimension."""
    v = _c(col)
    bad = v.isNull() | F.exists(v, lambda x: x.isNull() | F.isnan(x))
    return F.when(bad, F.raise_error(F.lit("NULL or NaN point"))).otherwise(v)


def _checked(a: Column, b: Column, value: Column, dim: int | None) -> Column:
    """Raise on unequal sizes instead of returning NULL (which max/avg would skip)."""
    if dim is None:
        bad = F.size(a) != F.size(b)
    else:
        bad = (F.size(a) != F.lit(dim)) | (F.size(b) != F.lit(dim))
    return F.when(bad, F.raise_error(F.lit("points of unequal dimension"))).otherwise(value)


def sq_euclidean(a: str | Column, b: str | Column, dim: int | None = None,
                 drop_last: bool = False, check: bool = True) -> Column:
    """Squared Euclidean distance; ``drop_last`` skips the last coordinate."""
    if isinstance(a, str) and isinstance(b, str) and dim is not None and dim <= UNROLL_LIMIT:
        # parsed once as SQL text: one call instead of a py4j call per term
        n = dim - 1 if drop_last else dim
        body = " + ".join(f"(`{a}`[{i}] - `{b}`[{i}]) * (`{a}`[{i}] - `{b}`[{i}])" for i in range(n)) or "0D"
        value = F.expr(body)
        if not check:
            return value
        return F.expr(f"CASE WHEN size(`{a}`) != {dim} OR size(`{b}`) != {dim} "
                      f"THEN raise_error('points of unequal dimension') ELSE {body} END")
    a, b = _c(a), _c(b)
    if dim is not None and dim <= UNROLL_LIMIT:
        n = dim - 1 if drop_last else dim
        if n <= 0:
            value = F.lit(0.0)
        else:
            value = None
            for i in range(n):
                t = (a[i] - b[i]) * (a[i] - b[i])
                value = t if value is None else value + t
    else:
        x, y = a, b
        if drop_last:
            x = F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))
            y = F.slice(b, 1, F.greatest(F.size(b) - 1, F.lit(0)))
        value = F.aggregate(F.zip_with(x, y, lambda p, q: (p - q) * (p - q)),
                            F.lit(0.0), lambda acc, t: acc + t)
    return _checked(a, b, value, dim) if check else value


def euclidean(a: str | Column, b: str | Column, dim: int | None = None,
              check: bool = True) -> Column:
    """Euclidean distance over all coordinates."""
    return F.sqrt(sq_euclidean(a, b, dim, check=check))


def euclidean_2d(a: str | Column, b: str | Column) -> Column:
    """Distance over the first two coordinates only."""
    a, b = _c(a), _c(b)
    return F.hypot(a[0] - b[0], a[1] - b[1])


def metric_distance(a: str | Column, b: str | Column, metric: str = "euclidean",
                    dim: int | None = None, check: bool = True) -> Column:
    if metric == "euclidean":
        return euclidean(a, b, dim, check=check)
    if metric == "sq_drop_last":
        return sq_euclidean(a, b, dim, drop_last=True, check=check)
    if metric == "euclidean_2d":
        return euclidean_2d(a, b)
    raise ValueError(f"unknown metric {metric!r}")


def double_literal(x: float) -> str:
    """SQL text of a double that parses back to the same bits."""
    x = float(x)
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return repr(x) + "D"


def vector_literal_sql(vec: Sequence[float]) -> str:
    return "array(" + ", ".join(double_literal(x) for x in vec) + ")"


# fixed values: the seeded uniform uses the first 12 hex digits (48 bits) of md5
UNIFORM_HEX_DIGITS = 12
UNIFORM_SCALE = float(2 ** 48)


def seeded_key(seed: int, *parts: str | Column) -> Column:
    """``md5('seed:part1:part2...')`` as a hex string; the sampling sort key."""
    cols = [F.lit(str(seed))] + [_c(p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *cols))


def seeded_number(seed: int, *parts: str | Column) -> Column:
    """The first 60 bits of ``seeded_key`` as a long, in the same order."""
    return F.conv(F.substring(seeded_key(seed, *parts), 1, 15), 16, 10).cast("long")


def seeded_uniform(seed: int, *parts: str | Column) -> Column:
    """Uniform in (0, 1) from md5 of ``seed:parts``; identical in DuckDB."""
    hexpart = F.substring(seeded_key(seed, *parts), 1, UNIFORM_HEX_DIGITS)
    return (F.conv(hexpart, 16, 10).cast("double") + F.lit(0.5)) / F.lit(UNIFORM_SCALE)


def distance_to_literal(v_col: str, vec, metric: str = "euclidean") -> Column:
    """Distance from column ``v_col`` to one literal vector, as a single SQL expression.

    Unrolled into ``sqrt((v[0]-c0)*(v[0]-c0) + ...)`` and parsed once, so the
    plan is built in one call and compiles into whole-stage codegen. Points of
    another dimension raise.
    """
    vec = [float(x) for x in vec]
    n = len(vec) - 1 if metric == "sq_drop_last" else len(vec)
    if len(vec) > UNROLL_LIMIT:
        lit = vector_literal_sql(vec)
        body = (f"aggregate(zip_with(`{v_col}`, {lit}, (x, y) -> (x - y) * (x - y)), 0D, (a, t) -> a + t)")
    else:
        terms = [f"(`{v_col}`[{i}] - {double_literal(c)}) * (`{v_col}`[{i}] - {double_literal(c)})"
                 for i, c in enumerate(vec[:n])]
        body = " + ".join(terms) if terms else "0D"
    expr = body if metric == "sq_drop_last" else f"sqrt({body})"
    return F.expr(f"CASE WHEN size(`{v_col}`) != {len(vec)} THEN raise_error('points of unequal dimension') "
                  f"ELSE {expr} END")
