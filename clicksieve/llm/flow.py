"""Min-cost flow on a small graph: successive shortest paths with potentials."""

import heapq


class Network:
    """Nodes are any hashable names; capacities are whole numbers, costs are not negative."""

    def __init__(self):
        self.number, self.arcs, self.out = {}, [], []

    def node(self, name):
        if name not in self.number:
            self.number[name] = len(self.out)
            self.out.append([])
        return self.number[name]

    def arc(self, tail, head, capacity, cost):
        """Adds an arc and returns its number; ``flow_on`` tells what it carries."""
        a, b = self.node(tail), self.node(head)
        self.arcs += [[b, capacity, cost], [a, 0, -cost]]
        self.out[a].append(len(self.arcs) - 2)
        self.out[b].append(len(self.arcs) - 1)
        return len(self.arcs) - 2

    def flow_on(self, arc):
        return self.arcs[arc + 1][1]

    def _shortest(self, source, potential):
        far = [None] * len(self.out)
        via, far[source] = [None] * len(self.out), 0
        heap, done = [(0, source)], set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            for number in self.out[u]:
                v, left, cost = self.arcs[number]
                if left <= 0 or v in done:
                    continue
                reach = d + cost + potential[u] - potential[v]
                if far[v] is None or reach < far[v]:
                    far[v], via[v] = reach, number
                    heapq.heappush(heap, (reach, v))
        return far, via

    def solve(self, source, sink):
        """Sends as much as possible from ``source`` to ``sink``, at least cost."""
        source, sink = self.node(source), self.node(sink)
        potential = [0] * len(self.out)
        while True:
            far, via = self._shortest(source, potential)
            if far[sink] is None:
                return
            potential = [p + (d if d is not None else far[sink]) for p, d in zip(potential, far)]
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.arcs[via[at] ^ 1][0]
            amount = min(self.arcs[number][1] for number in path)
            for number in path:
                self.arcs[number][1] -= amount
                self.arcs[number ^ 1][1] += amount
