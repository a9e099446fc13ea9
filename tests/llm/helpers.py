"""Texts and brute-force versions that several tests use."""


def prose(rng, n, vocabulary=400):
    words = ["".join(rng.choice(list("abcdefghijklmnoprstu"), rng.integers(2, 9))) for _ in range(vocabulary)]
    return " ".join(words[i] for i in rng.integers(0, vocabulary, n))


def union_find(edges):
    """Node -> smallest node of its component, for nodes with an edge to another one."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}
