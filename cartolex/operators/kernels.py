"""Graph kernels in plain Python for adjacency that fits one task: the small-graph strategy, and all-sources searches."""

from __future__ import annotations

import heapq
from collections import defaultdict, deque


def pagerank(nodes: list[str], edges: list[tuple[str, str, float]], damping: float = 0.85, rounds: int = 100, tol: float = 1e-6) -> tuple[dict[str, float], bool]:
    """Ranks by weighted out-edges, dangling mass spread evenly; and whether the L1 change fell below len(nodes) * tol."""
    n = len(nodes)
    if not n:
        return {}, True
    total: dict[str, float] = defaultdict(float)
    for s, _, w in edges:
        total[s] += w
    into: dict[str, list[tuple[str, float]]] = defaultdict(list)
    for s, t, w in edges:
        if total[s] > 0:
            into[t].append((s, w / total[s]))
    dangling = [v for v in nodes if not total[v] > 0]
    x = dict.fromkeys(nodes, 1.0 / n)
    for _ in range(rounds):
        loose = sum(x[v] for v in dangling) / n
        new = {v: damping * (sum(x[s] * w for s, w in into[v]) + loose) + (1 - damping) / n for v in nodes}
        change = sum(abs(new[v] - x[v]) for v in nodes)
        x = new
        if change < n * tol:
            return x, True
    return x, False


def distances(source: str, out: dict[str, list[tuple[str, float]]]) -> dict[str, float]:
    """The least sum of lengths (none below 0) from a source to each node that it reaches, nearest first."""
    final: dict[str, float] = {}
    open_ = [(0.0, source)]
    while open_:
        d, v = heapq.heappop(open_)
        if v not in final:
            final[v] = d
            for w, length in out.get(v, ()):
                if w not in final:
                    heapq.heappush(open_, (d + length, w))
    return final


def from_source(source: str, out: dict[str, list[tuple[str, float]]]) -> tuple[dict[str, float], dict[str, float]]:
    """Distances from a source, and each node's share of the shortest paths from it to others (its dependency).

    An edge is on a shortest path where its length is what its ends' distances differ by, as they add up; so the paths to
    a node are those to the tails of such edges, counted outwards, and dependencies flow back along them.
    """
    far = distances(source, out)
    place = {v: k for k, v in enumerate(far)}
    tight = [(v, w) for v in far for w, length in out.get(v, ()) if w != source and place[v] < place[w] and far[v] + length == far[w]]
    paths = dict.fromkeys(far, 0.0)
    paths[source] = 1.0
    for v, w in tight:  # tails come in the order of their distances
        paths[w] += paths[v]
    share = dict.fromkeys(far, 0.0)
    # A head is complete before any edge into it is used: edges go by their heads, farthest first.
    for v, w in sorted(tight, key=lambda e: -place[e[1]]):
        share[v] += paths[v] * (1 + share[w]) / paths[w]
    del share[source]
    return far, share


def closeness(distance: dict[str, float], n: int) -> float:
    """Reached nodes per distance, scaled by the share of the graph that is reached."""
    total = sum(distance.values())
    if n <= 1 or total <= 0 or total == float("inf"):
        return 0.0
    r = len(distance) - 1
    return r / total * (r / (n - 1))


def strong_components(nodes: list[str], out: dict[str, list[str]]) -> list[list[str]]:
    """Tarjan's, without recursion; components come out after those that they reach."""
    index: dict[str, int] = {}
    low: dict[str, int] = {}
    on: set[str] = set()
    stack: list[str] = []
    parts: list[list[str]] = []
    for root in nodes:
        if root in index:
            continue
        work = [(root, iter(out.get(root, ())))]
        index[root] = low[root] = len(index)
        stack.append(root)
        on.add(root)
        while work:
            v, more = work[-1]
            for w in more:
                if w not in index:
                    index[w] = low[w] = len(index)
                    stack.append(w)
                    on.add(w)
                    work.append((w, iter(out.get(w, ()))))
                    break
                if w in on:
                    low[v] = min(low[v], index[w])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[v])
                if low[v] == index[v]:
                    part = []
                    while True:
                        w = stack.pop()
                        on.discard(w)
                        part.append(w)
                        if w == v:
                            break
                    parts.append(part)
    return parts


def prerequisites(nodes: list[str], edges: list[tuple[str, str]], difficulty: dict[str, float]) -> dict[str, tuple[int, float]]:
    """Depth (longest chain of components before a node) and effort (own component plus the costliest chain before it)."""
    out: dict[str, list[str]] = defaultdict(list)
    for s, t in edges:
        out[s].append(t)
    parts = strong_components(nodes, out)
    where = {v: k for k, p in enumerate(parts) for v in p}
    before: dict[int, set[int]] = defaultdict(set)
    for s, t in edges:
        if where[s] != where[t]:
            before[where[t]].add(where[s])
    depth, effort = [0] * len(parts), [0.0] * len(parts)
    for k in reversed(range(len(parts))):  # sources first
        depth[k] = max((depth[p] + 1 for p in before[k]), default=0)
        effort[k] = sum(difficulty[v] for v in parts[k]) + max((effort[p] for p in before[k]), default=0.0)
    return {v: (depth[where[v]], effort[where[v]]) for v in nodes}


def communities(nodes: list[str], edges: list[tuple[str, str, float]], resolution: float = 1.0) -> dict[str, int]:
    """Louvain communities of the undirected projection (weights of both directions add up), numbered by their least node.

    Nodes move in order to the community of the largest gain, ties to the smallest label, so results repeat.
    """
    weight: dict[tuple[str, str], float] = defaultdict(float)
    for s, t, w in edges:
        if s != t:
            weight[min(s, t), max(s, t)] += w
    label = {v: v for v in nodes}  # each node's community at the top level
    units = list(nodes)
    links: dict[str, dict[str, float]] = {v: {} for v in units}
    loops: dict[str, float] = defaultdict(float)
    for (s, t), w in weight.items():
        links[s][t] = links[t][s] = w
    m = sum(weight.values())
    while m > 0:
        own = {v: v for v in units}
        degree = {v: sum(links[v].values()) + 2 * loops[v] for v in units}
        total = dict(degree)
        moved = True
        while moved:
            moved = False
            for v in units:
                around: dict[str, float] = defaultdict(float)
                for u, w in links[v].items():
                    around[own[u]] += w
                home = own[v]
                total[home] -= degree[v]
                gain = lambda k: around.get(k, 0.0) - resolution * total[k] * degree[v] / (2 * m)  # noqa: B023, E731
                best, most = home, gain(home)
                for k in sorted(around):
                    if gain(k) > most + 1e-12:
                        best, most = k, gain(k)
                total[best] += degree[v]
                if best != home:
                    own[v] = best
                    moved = True
        if len(set(own.values())) == len(units):
            break
        label = {v: own[k] for v, k in label.items()}
        merged: dict[str, dict[str, float]] = {k: defaultdict(float) for k in set(own.values())}
        new_loops: dict[str, float] = defaultdict(float)
        for v in units:
            new_loops[own[v]] += loops[v]
            for u, w in links[v].items():
                if own[u] == own[v]:
                    new_loops[own[v]] += w / 2
                else:
                    merged[own[v]][own[u]] += w
        units, links, loops = sorted(merged), merged, new_loops
    least: dict[str, str] = {}
    for v, k in label.items():
        least[k] = min(least.get(k, v), v)
    rank = {k: i for i, k in enumerate(sorted(least, key=least.__getitem__))}
    return {v: rank[k] for v, k in label.items()}


def hops(start: str, out: dict[str, list[str]], goal: str | None = None) -> dict[str, str | None]:
    """Parents by breadth-first search, in the order of the adjacency."""
    parent: dict[str, str | None] = {start: None}
    queue = deque([start])
    while queue:
        v = queue.popleft()
        if v == goal:
            break
        for w in out.get(v, ()):
            if w not in parent:
                parent[w] = v
                queue.append(w)
    return parent


def walk(parent: dict[str, str | None], goal: str) -> list[str]:
    path = [goal]
    while (v := parent[path[-1]]) is not None:
        path.append(v)
    return path[::-1]
