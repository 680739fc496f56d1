"""Point arithmetic as column expressions (V1, V2, V3).

Centers are at most ``kernels`` rows held by the driver (a parameter, not a
function of the data size), so they enter the plan as literals: no join, no
shuffle, no UDF, and the nearest-center search compiles into the same whole-stage
code span as the scan and the partial aggregate that follow. It has two forms: the
definition (one array of distances and its first minimum per row), and the
interval search that the fit and the assignment use.

The expression is emitted as SQL text: one call to the JVM, instead of
hundreds of small column-building calls per fit iteration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sq_distance_sql(xd: str, yd: str, mx: str, my: str) -> str:
    """V1: squared euclidean distance (no root) of SQL terms, exact in double
    arithmetic for integer coordinates below 2**26."""
    return f"({xd} - {mx}) * ({xd} - {mx}) + ({yd} - {my}) * ({yd} - {my})"


def nearest_position_sql(x: str, y: str, centers: Sequence[tuple[str, str]]) -> str:
    """SQL text of V2 over the columns named ``x`` and ``y``: the position (from 0)
    of the nearest of ``centers``, given as pairs of SQL terms.

    The distances form one array; the first position of its minimum is the
    nearest center, so equal distances go to the earlier one.
    """
    if not centers:
        raise ValueError("at least one center is needed")
    xd, yd = f"CAST({_quote(x)} AS DOUBLE)", f"CAST({_quote(y)} AS DOUBLE)"
    dists = "array(" + ", ".join(sq_distance_sql(xd, yd, mx, my) for mx, my in centers) + ")"
    return f"CAST(array_position({dists}, array_min({dists})) - 1 AS INT)"


def nearest_center_sql(x: str, y: str, centers: Sequence[tuple[int, int, int]]) -> str:
    """V2 with literal centers: the cid of the nearest one, the lowest of equals."""
    pos = nearest_position_sql(x, y, [(f"{float(mx)!r}D", f"{float(my)!r}D") for _, mx, my in centers])
    cids = [int(c) for c, _, _ in centers]
    if cids == list(range(len(cids))):
        return pos
    if sorted(cids) != cids:
        raise ValueError("centers must be listed in increasing cid order")
    return f"element_at(array({', '.join(map(str, cids))}), {pos} + 1)"


def nearest_center(x: str, y: str, centers: Sequence[tuple[int, int, int]]) -> Column:
    """V2: cid of the closest center; equal distances go to the lowest cid."""
    return F.expr(nearest_center_sql(x, y, centers))


def point_shift(a: tuple[int, int], b: tuple[int, int]) -> float:
    """V1 on two driver-side points."""
    dx = float(a[0] - b[0])
    dy = float(a[1] - b[1])
    return dx * dx + dy * dy


def total_shift(old: Sequence[tuple[int, int]], new: Sequence[tuple[int, int]]) -> float:
    """V3: sum of squared distances between matching centers (k driver rows),
    summed in center order."""
    if len(old) != len(new):  # C5
        raise ValueError("both center lists must have the same length")
    total = 0.0
    for a, b in zip(old, new):
        total += point_shift(a, b)
    return total


# --- V2 as an interval search -------------------------------------------------
# Seen from one x, the nearest center over y is a lower envelope: each center on it is the
# nearest from one y on, up to where the next one takes over. So an x has at most one break
# point a center, and a point finds its center by binary search among these.

LEAST_Y = -(1 << 63)


def envelope(centers: Sequence[tuple[int, int]], x: int) -> list[tuple[int, int]]:
    """``(start, position)``, by start: the center at ``position`` is the nearest to (x, y) from
    whole y = ``start`` on; of equally near ones it is the one listed first. Whole-number
    arithmetic, so exact for coordinates of any size."""

    def takes_over(low, high) -> int:
        """The least y from which ``high`` (of larger center y) comes before ``low``."""
        (y0, off0, i0), (y1, off1, i1) = low, high
        num, den = off1 - off0 + y1 * y1 - y0 * y0, 2 * (y1 - y0)
        return num // den + 1 if i0 < i1 else -(-num // den)

    found: list[tuple[int, tuple[int, int, int]]] = []
    for line in sorted((my, (x - mx) ** 2, i) for i, (mx, my) in enumerate(centers)):
        if found and found[-1][1][0] == line[0]:
            continue  # of centers with one y only the first can be the nearest
        while found and takes_over(found[-1][1], line) <= found[-1][0]:
            found.pop()
        found.append((takes_over(found[-1][1], line) if found else LEAST_Y, line))
    return [(start, i) for start, (_, _, i) in found]


def with_nearest(rows: DataFrame, centers: Sequence[tuple[int, int]], xs: Sequence[int], name: str = "pos") -> DataFrame:
    """V2: ``rows`` with the position of the nearest of ``centers``, by binary search among the break
    points of the row's x. ``xs`` are the different x of the rows: as many as languages, or so.

    The break points are constants that the generated code refers to, so a fit compiles one
    code for all its steps.
    """
    seen = {x: envelope(centers, x) for x in xs}
    # a start that no y reaches need not fit into the type
    by_x = lambda part: "CASE x " + " ".join(f"WHEN {x} THEN array({part(e)})" for x, e in seen.items()) + " END"
    within = lambda start: max(LEAST_Y + 1, min(start, -LEAST_Y - 1))
    starts = by_x(lambda e: ", ".join(f"{within(s)}L" for s, _ in e))
    owners = by_x(lambda e: ", ".join(str(i) for _, i in e))
    bits = max(1, (len(centers) - 1).bit_length())
    # a column each, made of the one before: one expression for all would hold every lookup many times
    search = [f"{starts} AS _starts"]
    for i in range(bits):
        step, was = 1 << (bits - 1 - i), f"_at{i - 1}" if i else "0"
        search.append(f"{was} + if(get(_starts, {was} + {step}) <= y, {step}, 0) AS _at{i}")
    found = rows.selectExpr("*", *search, f"get({owners}, _at{bits - 1}) AS {name}")
    return found.drop("_starts", *[f"_at{i}" for i in range(bits)])
