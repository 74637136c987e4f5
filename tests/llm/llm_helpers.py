"""Plain helpers of the tests."""


def components_of(count, links):
    """Smallest member of the component of each number below ``count``."""
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(count)]
