"""Data that several test modules share; a module of its own, because every test folder has its own ``conftest``."""

SMALL = "/root/testdata/sf0.001"


def macro_values(i):
    return 1000.0 + 30 * i, 2.0 + 0.2 * i, 90.0 + i, 5.0 - 0.1 * i, 100.0 + i, 10.0 + i
