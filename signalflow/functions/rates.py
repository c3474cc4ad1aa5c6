"""Rates and numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_100K = 100_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def incidence(cases, population, smoothing: float = 0.0) -> Column:
    """Cases per head; NULL in either input, or a zero population, gives NULL."""
    pop = _col(population) + F.lit(float(smoothing)) if smoothing else _col(population)
    return F.try_divide(_col(cases).cast("double"), pop)


def share(part, rest, smoothing: float = 1.0) -> Column:
    """``part / (part + rest + smoothing)``, 0 where it is undefined."""
    part, rest = _col(part), _col(rest)
    total = part + rest + F.lit(float(smoothing)) if smoothing else part + rest
    return F.coalesce(F.try_divide(part.cast("double"), total), F.lit(0.0))


def scaled_target(c, name: str) -> Column:
    """Incidences are modelled per 100 000, other targets as they are."""
    return _col(c) * F.lit(float(PER_100K)) if "incidence" in name else _col(c)


def spline_cell(c, period: float, n_splines: int) -> tuple[Column, Column]:
    """Knot interval of ``c`` on the period, and the weights of the four splines that reach into it.

    Knots are evenly spaced over one period. The cubic B-spline that starts ``m`` knots
    before the interval has weight ``m`` of the array.
    """
    position = F.pmod(_col(c).cast("double"), F.lit(float(period))) * F.lit(n_splines / period)
    cell = F.floor(position).cast("int")
    u = position - cell
    weights = F.array(
        u * u * u / 6,
        (((u * -3 + 3) * u + 3) * u + 1) / 6,
        ((u * 3 - 6) * u * u + 4) / 6,
        (1 - u) * (1 - u) * (1 - u) / 6,
    )
    return cell, weights


def spline_value(cell: Column, weights: Column, i: int, n_splines: int) -> Column:
    """Spline ``i`` of the periodic basis (it starts three knots before knot ``i``)."""
    return F.coalesce(F.get(weights, F.pmod(cell + F.lit(3 - i), F.lit(n_splines))), F.lit(0.0))
