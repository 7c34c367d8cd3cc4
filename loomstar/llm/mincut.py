"""The two-way labelling of least cost: a minimum cut between what speaks for the one label and what speaks for the other."""

from __future__ import annotations

from collections import deque


def least_cost(unary: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """For each node whether it is on the source's side of a minimum cut.

    ``unary`` is what the false label costs more than the true one; an edge (a, b, w) costs ``w`` where its ends differ. A node
    that outweighs all its edges has its label for sure: it is fixed, and what its edges ask for is added to its neighbours.
    Maximum flow decides the rest. Of several cuts of least cost the one with the fewest true labels among them is taken.
    """
    beside: list[list[tuple[int, int]]] = [[] for _ in unary]
    for a, b, w in edges:
        beside[a].append((b, w))
        beside[b].append((a, w))
    lean, pull = list(unary), [sum(w for _, w in near) for near in beside]
    label: list[bool | None] = [None] * len(unary)
    queue = deque(range(len(unary)))
    while queue:
        x = queue.popleft()
        if label[x] is not None or abs(lean[x]) <= pull[x] and (pull[x] or lean[x]):
            continue
        label[x] = lean[x] > 0
        for y, w in beside[x]:
            if label[y] is None:
                lean[y] += w if label[x] else -w
                pull[y] -= w
                queue.append(y)
    open_nodes = [x for x in range(len(unary)) if label[x] is None]
    if open_nodes:
        number = {x: k for k, x in enumerate(open_nodes)}
        inner = [(number[a], number[b], w) for a, b, w in edges if a in number and b in number]
        for x, side in zip(open_nodes, _max_flow([lean[x] for x in open_nodes], inner)):
            label[x] = side
    return [bool(x) for x in label]


def _max_flow(unary: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node can still be reached from the source after a maximum flow (shortest paths first, level by level)."""
    n = len(unary)
    source, sink = n, n + 1
    out: list[list[int]] = [[] for _ in range(n + 2)]
    head, room = [], []

    def add(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(head))
        out[b].append(len(head) + 1)
        head.extend((b, a))
        room.extend((there, back))

    for x, u in enumerate(unary):
        if u > 0:
            add(source, x, u, 0)
        elif u < 0:
            add(x, sink, -u, 0)
    for a, b, w in edges:
        add(a, b, w, w)

    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in out[x]:
                if room[e] and level[head[e]] < 0:
                    level[head[e]] = level[x] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return [level[x] >= 0 for x in range(n)]
        at, path, x = [0] * (n + 2), [], source
        while True:
            if x == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(k for k, e in enumerate(path) if not room[e])
                x = head[path[full] ^ 1]
                del path[full:]
                continue
            edges_of = out[x]
            while at[x] < len(edges_of) and not (room[edges_of[at[x]]] and level[head[edges_of[at[x]]]] == level[x] + 1):
                at[x] += 1
            if at[x] < len(edges_of):
                path.append(edges_of[at[x]])
                x = head[path[-1]]
            elif x == source:
                break
            else:
                e = path.pop()
                x = head[e ^ 1]
                at[x] += 1
