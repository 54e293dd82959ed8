"""A small overlay kernel: geometries as lists of convex pieces, counter-clockwise lists of (x, y).

A simple polygon is cut into triangles; intersections and differences of convex pieces are clips by half-planes, so the pieces
are closed under both. Areas are planar.
"""

from __future__ import annotations

from collections.abc import Iterable

Point = tuple[float, float]
Piece = list[Point]
EPS = 1e-12


def area(piece: Piece) -> float:
    """Signed area; counter-clockwise is positive."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(piece, piece[1:] + piece[:1])) / 2


def total(pieces: Iterable[Piece]) -> float:
    return sum(abs(area(p)) for p in pieces)


def centroid(pieces: list[Piece]) -> Point:
    x = y = w = 0.0
    for p in pieces:
        for a, b in zip(p, p[1:] + p[:1]):
            c = (a[0] * b[1] - b[0] * a[1]) / 2
            x, y, w = x + c * (a[0] + b[0]) / 3, y + c * (a[1] + b[1]) / 3, w + c
    return (x / w, y / w) if w else pieces[0][0]


def _turn(a: Point, b: Point, c: Point) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def is_convex(ring: Piece) -> bool:
    n = len(ring)
    return all(_turn(ring[i], ring[(i + 1) % n], ring[(i + 2) % n]) >= 0 for i in range(n))


def triangles(ring: Piece) -> list[Piece]:
    """Ears of a simple counter-clockwise ring, one after the other."""
    left, out = list(ring), []
    while len(left) > 3:
        n = len(left)
        for i in range(n):
            a, b, c = left[i - 1], left[i], left[(i + 1) % n]
            turn = _turn(a, b, c)
            if turn < 0:
                continue
            if turn > 0 and any(p not in (a, b, c) and _turn(a, b, p) >= 0 and _turn(b, c, p) >= 0 and _turn(c, a, p) >= 0 for p in left):
                continue
            if turn > 0:
                out.append([a, b, c])
            del left[i]
            break
        else:  # a ring that isn't simple
            break
    return out + ([left] if len(left) == 3 and _turn(*left) > 0 else [])


def pieces_of(ring: Iterable[Point]) -> list[Piece]:
    """Convex pieces of a simple ring, closed or open, of either sense."""
    points = [tuple(p) for p in ring]
    if len(points) > 1 and points[0] == points[-1]:
        points.pop()
    points = [p for i, p in enumerate(points) if p != points[i - 1]]
    if len(points) < 3:
        return []
    if area(points) < 0:
        points.reverse()
    return [points] if is_convex(points) else triangles(points)


def clip(piece: Piece, a: Point, b: Point) -> Piece:
    """The part of a convex piece on the left of the line from a to b."""
    out: Piece = []
    sides = [_turn(a, b, p) for p in piece]
    for i, p in enumerate(piece):
        q, s, t = piece[(i + 1) % len(piece)], sides[i], sides[(i + 1) % len(piece)]
        if s >= -EPS:
            out.append(p)
        if (s > EPS and t < -EPS) or (s < -EPS and t > EPS):
            k = s / (s - t)
            out.append((p[0] + k * (q[0] - p[0]), p[1] + k * (q[1] - p[1])))
    return out if len(out) > 2 and area(out) > EPS else []


def intersection(left: list[Piece], right: list[Piece]) -> list[Piece]:
    out = []
    for p in left:
        for q in right:
            part = p
            for a, b in zip(q, q[1:] + q[:1]):
                part = part and clip(part, a, b)
            if part:
                out.append(part)
    return out


def difference(left: list[Piece], right: list[Piece]) -> list[Piece]:
    for q in right:
        kept = []
        for p in left:
            inside = p
            for a, b in zip(q, q[1:] + q[:1]):
                outside = clip(inside, b, a)
                if outside:
                    kept.append(outside)
                inside = clip(inside, a, b)
                if not inside:
                    break
        left = kept
    return left


def union(parts: Iterable[list[Piece]]) -> list[Piece]:
    out: list[Piece] = []
    for part in parts:
        out += difference(part, out)
    return out


def border(left: list[Piece], right: list[Piece]) -> float:
    """Planar length of the sides of two geometries that lie on one another."""
    found = 0.0
    for p in left:
        for a, b in zip(p, p[1:] + p[:1]):
            dx, dy = b[0] - a[0], b[1] - a[1]
            n = dx * dx + dy * dy
            for q in right:
                for c, d in zip(q, q[1:] + q[:1]):
                    if abs(_turn(a, b, c)) <= 1e-9 * max(1.0, n) and abs(_turn(a, b, d)) <= 1e-9 * max(1.0, n) and n:
                        s, t = sorted((((c[0] - a[0]) * dx + (c[1] - a[1]) * dy) / n, ((d[0] - a[0]) * dx + (d[1] - a[1]) * dy) / n))
                        found += max(0.0, min(1.0, t) - max(0.0, s)) * n**0.5
    return found


def voronoi(pieces: list[Piece], seeds: list[Point]) -> list[list[Piece]]:
    """The part of a geometry that is nearest to each seed, by clips with bisectors."""
    cells = []
    for i, (x, y) in enumerate(seeds):
        own = pieces
        for j, (u, v) in enumerate(seeds):
            if i != j and own:
                mid, along = ((x + u) / 2, (y + v) / 2), (-(v - y), u - x)
                a, b = (mid[0] + along[0], mid[1] + along[1]), mid
                if _turn(a, b, (x, y)) < 0:
                    a, b = b, a
                own = [c for p in own if (c := clip(p, a, b))]
        cells.append(own)
    return cells


def _crossing(a: Point, b: Point, c: Point, d: Point) -> Point | None:
    """Where the insides of two segments cross."""
    s, t = _turn(a, b, c), _turn(a, b, d)
    u, v = _turn(c, d, a), _turn(c, d, b)
    if s * t < 0 and u * v < 0:
        k = u / (u - v)
        return a[0] + k * (b[0] - a[0]), a[1] + k * (b[1] - a[1])
    return None


def repaired(ring: Iterable[Point]) -> tuple[list[Piece], bool]:
    """Simple counter-clockwise rings that a ring consists of, and whether it was other than one of them.

    Repeated points and spikes go; where the ring crosses or touches itself it is cut into loops. Loops without area are dropped.
    """
    given = [tuple(map(float, p)) for p in ring]
    points = given[:-1] if len(given) > 1 and given[0] == given[-1] else list(given)
    whole = len(points)
    points = [p for i, p in enumerate(points) if p != points[i - 1]]
    n = len(points)
    path: list[Point] = []
    for i in range(n):
        a, b = points[i], points[(i + 1) % n]
        cuts = [x for j in range(n) if j != i and (x := _crossing(a, b, points[j], points[(j + 1) % n]))]
        path += [a, *sorted(set(cuts), key=lambda x: (x[0] - a[0]) ** 2 + (x[1] - a[1]) ** 2)]
    key = lambda p: (round(p[0], 12), round(p[1], 12))
    loops: list[Piece] = []
    stack: list[Point] = []
    seen: dict[tuple, int] = {}
    for p in path:
        if key(p) in seen:
            at = seen[key(p)]
            loops.append(stack[at:])
            for q in stack[at + 1 :]:
                del seen[key(q)]
            del stack[at + 1 :]
        else:
            seen[key(p)] = len(stack)
            stack.append(p)
    loops.append(stack)
    kept = [loop if area(loop) > 0 else loop[::-1] for loop in loops if len(loop) > 2 and abs(area(loop)) > EPS]
    same = len(kept) == 1 and len(kept[0]) == whole and area(points) > 0
    return sorted(kept), not same
