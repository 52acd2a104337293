import random
from collections import deque

import pytest

from sitewatch.operators import reach as ops
from tests.helpers import T1, rows

SITE = "https://s.org/#!"


def url(name):
    return SITE if name == "root" else f"{SITE}/{name}"


def links_of(spark, edges):
    return spark.createDataFrame(
        [(url(a), url(b)) for a, b in edges], "src_url string, dst_url string"
    )


EDGES = [("root", "a"), ("root", "b"), ("a", "b"), ("a", "a"), ("b", "root"), ("b", "c"), ("d", "a")]


def test_reached_and_emitted(spark):
    links = links_of(spark, EDGES)
    visited = ops.reach(*ops.store_links(links), SITE + "/")
    assert rows(visited) == [(url("root"), 0), (url("a"), 1), (url("b"), 1), (url("c"), 2)]
    emitted = ops.crawl_site(links, SITE + "/", T1)
    assert rows(emitted) == [("a", url("a"), 1), ("b", url("b"), 1)]
    everything = ops.crawl_site(links, SITE + "/", T1, require_outlink=False)
    assert rows(everything, "id") == [("a",), ("b",), ("c",)]


def test_start_without_any_link(spark):
    links = links_of(spark, [("d", "a")])
    assert rows(ops.reach(*ops.store_links(links), SITE)) == [(SITE, 0)]
    assert rows(ops.crawl_site(links, SITE, T1)) == []


@pytest.mark.parametrize("buckets, narrow, shard_links", [(1, 10_000, 10_000), (10, 10_000, 20), (10, 0, 20), (4, 30, 20)])
def test_depths_equal_a_plain_breadth_first_search(spark, buckets, narrow, shard_links):
    chance = random.Random(7)
    names = ["root"] + [f"p{i}" for i in range(120)]
    edges = [(chance.choice(names), chance.choice(names)) for _ in range(170)]
    # One page holds more than a third of all links, one target is linked from everywhere.
    edges += [("p3", name) for name in names] + [(name, "p5") for name in names]
    edges.append(("root", "p3"))
    expected, queue = {"root": 0}, deque(["root"])
    while queue:
        current = queue.popleft()
        for source, target in edges:
            if source == current and target not in expected:
                expected[target] = expected[current] + 1
                queue.append(target)
    stored, buckets = ops.store_links(links_of(spark, edges), buckets, shard_links)
    assert stored.count() == len(edges)
    got = rows(ops.reach(stored, buckets, SITE, narrow))
    assert got == sorted(((url(n), d) for n, d in expected.items()), key=repr)
