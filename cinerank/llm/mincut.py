"""Smallest cut of a graph with terminals, by blocking flows."""

from __future__ import annotations

from collections import deque


def labels(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source side of a minimum cut.

    `source[i]` is cut if node i falls to the sink, `sink[i]` if it falls to
    the source, an edge's weight if its ends part. Nodes whose terminals
    outweigh all their open edges are settled first, which leaves the same
    cut; blocking flows settle each rest component on its own.
    """
    n = len(source)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        if a != b and w > 0:
            near[a].append((b, w))
            near[b].append((a, w))
    s, t, open_ = list(source), list(sink), [sum(w for _, w in x) for x in near]
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(s[i] - t[i]) < open_[i]:
            continue
        side[i] = s[i] >= t[i]
        for j, w in near[i]:
            if side[j] is None:
                open_[j] -= w
                if side[i]:
                    s[j] += w
                else:
                    t[j] += w
                queue.append(j)
    seen = [x is not None for x in side]
    for i in range(n):
        if not seen[i]:
            part, queue = [], deque([i])
            seen[i] = True
            while queue:
                k = queue.popleft()
                part.append(k)
                for j, _ in near[k]:
                    if not seen[j]:
                        seen[j] = True
                        queue.append(j)
            _flow(part, near, s, t, side)
    return [bool(x) for x in side]


def _flow(part: list[int], near, s, t, side) -> None:
    """Levels by distance from the source, then flow along them until they
    are blocked; a phase looks at every edge about once."""
    at = {k: i for i, k in enumerate(part)}
    start, end = len(part), len(part) + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(len(part) + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)
    for k in part:
        both = min(s[k], t[k])
        if s[k] > both:
            edge(start, at[k], s[k] - both, 0.0)
        if t[k] > both:
            edge(at[k], end, t[k] - both, 0.0)
        for j, w in near[k]:
            if j > k and j in at:
                edge(at[k], at[j], w, w)
    while True:
        level = [-1] * len(out)
        level[start] = 0
        queue = deque([start])
        while queue:
            k = queue.popleft()
            for e in out[k]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[k] + 1
                    queue.append(to[e])
        if level[end] < 0:
            break
        next_ = [0] * len(out)
        path: list[int] = []
        k = start
        while True:
            if k == end:
                least = min(room[e] for e in path)
                cut = None
                for i, e in enumerate(path):
                    room[e] -= least
                    room[e ^ 1] += least
                    if cut is None and room[e] <= 1e-12:
                        cut = i
                k = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while next_[k] < len(out[k]):
                e = out[k][next_[k]]
                if room[e] > 1e-12 and level[to[e]] == level[k] + 1:
                    break
                next_[k] += 1
            if next_[k] < len(out[k]):
                path.append(out[k][next_[k]])
                k = to[path[-1]]
            elif path:
                level[k] = -1
                k = to[path.pop() ^ 1]
                next_[k] += 1
            else:
                break
    for k in part:
        side[k] = level[at[k]] >= 0
