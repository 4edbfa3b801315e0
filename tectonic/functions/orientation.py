"""Which side of a directed line a point lies on, with the exact sign for any doubles.

The cross product (x2 - x1)(y - y1) - (y2 - y1)(x - x1) is positive to the left of the line,
negative to its right and zero on it. In doubles its sign is certain when its size exceeds a known
bound on the rounding error; only below that bound is it computed again without rounding, as a sum
of doubles that holds the value exactly (products and differences with their rounding errors,
added without loss). Everything is a Spark SQL expression.

Coordinates are finite and zero or between 1e-140 and 1e140 in size (their products neither
overflow nor lose bits below the smallest double).
"""

from __future__ import annotations

# Fixed value: rounding error of the cross product of differences, relative to the sum of the
# sizes of its two products ((3 + 16 u) u with u = 2**-53).
ERROR_BOUND = "3.3306690738754716E-16D"
# Fixed value: splits a double into two halves of 26 bits (2**27 + 1).
SPLITTER = "134217729D"


def _exact_sql(x1: str, y1: str, x2: str, y2: str, x: str, y: str) -> str:
    """A double with the sign of the exact cross product."""
    h = "(_d.p - _d.q)"
    back = f"(_d.p - {h})"
    tail = f"((_d.p - ({h} + {back})) + ({back} - _d.q))"
    differences = ", ".join(f"named_struct('p', {p}, 'q', {q})" for p, q in
                            ((x2, x1), (y, y1), (y2, y1), (x, x1)))
    parts = f"transform(array({differences}), _d -> named_struct('h', {h}, 'l', {tail}))"
    pairs = ", ".join(f"named_struct('a', {sign}_p[{i}].{s}, 'b', _p[{j}].{t})"
                      for sign, i, j in (("", 0, 1), ("-", 2, 3)) for s in "lh" for t in "lh")
    factors = f"transform(array({parts}), _p -> array({pairs}))[0]"
    halves = (f"transform({factors}, _f -> named_struct('a', _f.a, 'b', _f.b, "
              f"'u', ({SPLITTER} * _f.a) - (({SPLITTER} * _f.a) - _f.a), "
              f"'v', ({SPLITTER} * _f.b) - (({SPLITTER} * _f.b) - _f.b)))")
    lost = ("((_s.a - _s.u) * (_s.b - _s.v) - (((_s.a * _s.b - _s.u * _s.v) - (_s.a - _s.u) * _s.v)"
            " - _s.u * (_s.b - _s.v)))")
    terms = f"flatten(transform({halves}, _s -> array({lost}, _s.a * _s.b)))"
    none = "cast(array() AS array<double>)"
    total = "(_g.q + _v)"
    error = f"((_g.q - ({total} - ({total} - _g.q))) + (_v - ({total} - _g.q)))"
    grown = (f"aggregate(_e, named_struct('q', _b, 'h', {none}), (_g, _v) -> "
             f"named_struct('q', {total}, 'h', array_append(_g.h, {error})), _g -> array_append(_g.h, _g.q))")
    summed = f"aggregate({terms}, {none}, (_e, _b) -> {grown})"
    # the last part that is not zero is larger than all before it together
    return f"aggregate({summed}, 0D, (_z, _w) -> CASE WHEN _w <> 0D THEN _w ELSE _z END)"


def orientation_sql(x1: str, y1: str, x2: str, y2: str, x: str, y: str) -> str:
    """SQL double that is positive, negative or zero as the point (x, y) lies left of, right of or
    on the line from (x1, y1) to (x2, y2). Arguments are SQL expressions, best plain names."""
    left = f"({x2} - {x1}) * ({y} - {y1})"
    right = f"({y2} - {y1}) * ({x} - {x1})"
    exact = _exact_sql(x1, y1, x2, y2, x, y)
    # a product that is zero is exactly zero, so the other one has the sign
    return (f"CASE WHEN {left} = 0D OR {right} = 0D OR "
            f"abs({left} - {right}) > {ERROR_BOUND} * (abs({left}) + abs({right})) "
            f"THEN {left} - {right} ELSE {exact} END")
