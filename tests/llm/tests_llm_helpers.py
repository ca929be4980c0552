"""Small helpers for the tests of this folder."""


def components(links, ids):
    """Smallest reachable id of every id."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(int(a)), find(int(b))
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
