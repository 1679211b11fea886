"""The package is sent to the executors once, also from many threads."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from plinth.session import ship_package


def test_package_is_shipped_once_by_many_threads():
    sent = []

    def add(path):
        time.sleep(0.05)
        sent.append(path)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(addPyFile=add))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(ship_package, [spark] * 8))
    assert len(sent) == 1
