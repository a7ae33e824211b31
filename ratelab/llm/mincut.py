"""Binary labelling of a small graph by a minimum cut.

Each node has a leaning: what it costs to label it against its sign. Each edge
costs its capacity if its ends differ. The labelling of least cost is the
minimum cut between a source and a sink whose capacities are the leanings.
"""

from collections import deque
from collections.abc import Sequence


def least_cost_labels(leanings: Sequence[int], edges: Sequence[tuple[int, int, int]]) -> list[bool]:
    """True for nodes on the source side; edges are ``(a, b, capacity)``, capacities above zero.

    A node that leans further than all its open edges together could pull it
    has the same label in every cut of least cost. It is settled first and its
    edges become leanings of its neighbours; the flow decides what is left. Of
    equally cheap labellings the one with most nodes on the source side counts.
    """
    n = len(leanings)
    lean = list(leanings)
    label: list[bool | None] = [None] * n
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    pull = [0] * n
    for a, b, capacity in edges:
        near[a].append((b, capacity))
        near[b].append((a, capacity))
        pull[a] += capacity
        pull[b] += capacity
    settled = [i for i in range(n) if abs(lean[i]) > pull[i]]
    while settled:
        i = settled.pop()
        if label[i] is not None:
            continue
        label[i] = lean[i] > 0
        for j, capacity in near[i]:
            if label[j] is None:
                lean[j] += capacity if label[i] else -capacity
                pull[j] -= capacity
                if abs(lean[j]) > pull[j]:
                    settled.append(j)
    left = [i for i in range(n) if label[i] is None]
    if left:
        number = {node: k for k, node in enumerate(left)}
        inner = [(number[a], number[b], c) for a, b, c in edges if a in number and b in number]
        for node, side in zip(left, _cut([lean[i] for i in left], inner)):
            label[node] = side
    return label


def _cut(leanings: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The cut nearest the sink, by shortest augmenting paths in layers."""
    n = len(leanings)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a, b, there, back):
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, leaning in enumerate(leanings):
        if leaning > 0:
            connect(source, i, leaning, 0)
        elif leaning < 0:
            connect(i, sink, -leaning, 0)
    for a, b, capacity in edges:
        connect(a, b, capacity, capacity)

    while True:
        layer = [-1] * (n + 2)
        layer[source] = 0
        queue = deque([source])
        while queue and layer[sink] < 0:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and layer[to[e]] < 0:
                    layer[to[e]] = layer[a] + 1
                    queue.append(to[e])
        if layer[sink] < 0:
            break
        tried = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(k for k, e in enumerate(path) if not room[e])
                at = to[path[full] ^ 1]
                del path[full:]
            elif tried[at] < len(out[at]):
                e = out[at][tried[at]]
                if room[e] and layer[to[e]] == layer[at] + 1:
                    path.append(e)
                    at = to[e]
                else:
                    tried[at] += 1
            elif path:
                at = to[path.pop() ^ 1]
                tried[at] += 1
            else:
                break

    # What still reaches the sink is its side; all else may go with the source at no more cost.
    reaches = [False] * (n + 2)
    reaches[sink] = True
    queue = deque([sink])
    while queue:
        b = queue.popleft()
        for e in out[b]:
            if room[e ^ 1] and not reaches[to[e]]:
                reaches[to[e]] = True
                queue.append(to[e])
    return [not r for r in reaches[:n]]
