"""On which side of a line a point lies, decided exactly.

Doubles are rounded, so the usual product of differences can have the wrong sign,
or none, where three points are nearly or exactly on one line.  Its sign is
taken only where it exceeds the most that rounding can amount to.  Elsewhere the
determinant is worked out without error: six products, each split into its
double and the rest that the double lost, are added up as a list of doubles that
do not overlap, whose last one gives the sign.  Both are column expressions; the
second is only evaluated on rows that need it.

Coordinates must be finite, with products neither above the range of doubles nor so
far below 1e-290 that their rests are lost.
"""

from __future__ import annotations

#: Half the distance from 1 to the next double, and the most that three rounded differences and products can be off.
EPSILON = 2.0 ** -53
ROUNDED = (3 + 16 * EPSILON) * EPSILON
#: Splits a double into two of half its digits.
SPLITTER = 2.0 ** 27 + 1

Point = tuple[str, str]


def _high(value: str) -> str:
    return f"({SPLITTER!r}D * {value} - ({SPLITTER!r}D * {value} - {value}))"


def sign_of_sum(products: list[tuple[str, str]]) -> str:
    """SQL for the exact sign (-1, 0, 1) of a sum of products of doubles."""
    pairs = ", ".join(f"named_struct('a', double({a}), 'b', double({b}))" for a, b in products)
    split = f"p -> named_struct('p', p.a * p.b, 'u', {_high('p.a')}, 'v', p.a - {_high('p.a')}, 's', {_high('p.b')}, 't', p.b - {_high('p.b')})"
    rest = "p -> array(p.v * p.t - (((p.p - p.u * p.s) - p.v * p.s) - p.u * p.t), p.p)"
    terms = f"flatten(transform(transform(array({pairs}), {split}), {rest}))"
    # Adding one double to a list: the sum goes on, what it loses stays.
    lost = "(s.q - ((s.q + v) - ((s.q + v) - s.q))) + (v - ((s.q + v) - s.q))"
    none = "cast(array() as array<double>)"
    grown = (f"(e, t) -> aggregate(e, named_struct('q', t, 'h', {none}), "
             f"(s, v) -> named_struct('q', s.q + v, 'h', concat(s.h, array({lost}))), s -> concat(s.h, array(s.q)))")
    return f"aggregate(aggregate({terms}, {none}, {grown}), 0, (s, v) -> if(v > 0, 1, if(v < 0, -1, s)))"


def sure_side_of(start: Point, end: Point, point: Point) -> str:
    """SQL for the side on which ``point`` lies, NULL where rounding leaves it open.

    Differences of doubles have the right sign, so products of different signs always pass the test.
    """
    (ax, ay), (bx, by), (cx, cy) = start, end, point
    left, right = f"(({bx} - {ax}) * ({cy} - {ay}))", f"(({by} - {ay}) * ({cx} - {ax}))"
    return (f"if(abs({left} - {right}) > {ROUNDED!r}D * (abs({left}) + abs({right})), int(signum({left} - {right})), "
            f"if({left} = 0D and {right} = 0D, 0, null))")


def _short_side_of(start: Point, end: Point, point: Point) -> str:
    """As ``sure_side_of``, where differences lose nothing and are so short that their products do not either; else NULL."""
    (ax, ay), (bx, by), (cx, cy) = start, end, point
    short = " and ".join(f"{p} - ({p} - {q}) = {q} and ({p} - {q}) + {q} = {p} and double(float({p} - {q})) = {p} - {q}"
                         for p, q in ((bx, ax), (cy, ay), (by, ay), (cx, ax)))
    return f"if({short}, int(signum(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))), null)"


def side_of(start: Point, end: Point, point: Point) -> str:
    """SQL for the side of the line from ``start`` to ``end`` on which ``point`` lies: 1 left, -1 right, 0 on it."""
    (ax, ay), (bx, by), (cx, cy) = start, end, point
    exact = sign_of_sum([(ax, by), (f"-{ay}", bx), (bx, cy), (f"-{by}", cx), (cx, ay), (f"-{cy}", ax)])
    return f"coalesce({sure_side_of(start, end, point)}, {_short_side_of(start, end, point)}, {exact})"


def sides_of(triples: list[tuple[Point, Point, Point]]) -> str:
    """SQL for an array with the side of each triple of start, end and point; the expression is there once for all."""
    rows = ", ".join("named_struct(" + ", ".join(
        f"'{name}', double({value})" for name, value in zip("abcdef", (*start, *end, *point), strict=True)) + ")"
        for start, end, point in triples)
    return f"transform(array({rows}), o -> {side_of(('o.a', 'o.b'), ('o.c', 'o.d'), ('o.e', 'o.f'))})"
