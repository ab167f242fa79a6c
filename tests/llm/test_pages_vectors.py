from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random

import numpy as np
import pytest

from locusframe.llm import cover_tree, url_filter, warc
from locusframe.llm.common import get_file

PAGES = [
    (1, "http://a.example.org/x?y=1#z", "<p>one</p>"),
    (2, "http://b.example.org/", "<p>one</p>"),
    (3, "https://a.example.org/x", "<p>two\r\n\r\nWARC/1.1</p>"),
    (4, None, None),
    (5, "not a url", ""),
    (6, "http://a.example.org/x y\n", "<p>one</p>"),
    (None, "http://z.org", "<p>one</p>"),
    (7, "http://a.example.org/x", "é" * 50_000),
    (8, "http://a.example.org/x", "<p>solo</p>"),
    (8, "http://a.example.org/x", "<p>solo</p>"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, uri string, rank int")


def test_warc_round_trip_and_merged_index(spark):
    manifest = warc.write_archives(pages(spark).repartition(3), archive_bytes=300)
    runs = warc.index_runs(manifest)
    assert runs.select("uri").distinct().count() == manifest.count() > 1
    rows = warc.merge_runs(warc.with_payload_size(runs)).collect()
    assert len(rows) == len(PAGES)
    rows.sort(key=lambda r: (r.shard, r.rank))
    keys = [(r.url_key, r.timestamp, r.page_id is not None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys)
    stored = {1: 6, 2: 6, 3: 3, 4: 5, 5: 5, 6: 6, None: 6, 7: 7, 8: 8}
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        row = next(r for r in rows if r.page_id == page_id)
        assert row.payload_bytes == len(payload)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = stored[page_id] != page_id
        assert (row.record_type, row.refers_to) == (("revisit", stored[page_id]) if again else ("response", None))
        record = gzip.decompress(get_file(row.uri)[row.offset : row.offset + row.length])
        assert record.startswith(b"WARC/1.1\r\n") and (again or record.endswith(payload + b"\r\n\r\n"))
    empty = warc.index_runs(warc.write_archives(pages(spark, [])))
    assert warc.merge_runs(empty).count() == 0
    kept = warc.index_runs(warc.write_archives(pages(spark), dedup_bytes=1 << 20))
    assert kept.where("record_type = 'revisit'").count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 8])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randint(0, 30), rng.random()) for _ in range(rng.randint(0, 40))) for _ in range(k)]
    assert list(warc.LoserTree(iter(r) for r in runs)) == sorted(x for r in runs for x in r)


RULES = [
    *url_filter.RULES,
    url_filter.Rule("a.example.org", "/es/", "allow"),
    url_filter.Rule("a.example.org", "/es/", "block"),
    url_filter.Rule("", "/private", "block"),
    url_filter.Rule("example.org", "", "allow"),
]
URLS = [
    "http://example.org/es/1", "http://EXAMPLE.org/en/12?x", "http://a.example.org/es/", "https://b.c.com/de/x#y",
    "http://badexample.org/es/", "http://org/", "http://x.org", "http://x.net/private/a", "http://x.net/pri", None, "",
    "nothing", "http://", "://x.com/fr/", "http://a.example.org?u=http://b.com/de/", "http://x.com/fr", "http://user@x.com:80/fr/",
]


def brute_rule(url: str | None, rules) -> tuple:
    import re

    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in rules
        if (host or path) and (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


@pytest.mark.parametrize("rules", [list(url_filter.RULES), RULES])
@pytest.mark.parametrize("trie_bytes", [1 << 20, 0])
def test_url_filter_by_trie_and_by_join(spark, rules, trie_bytes):
    frame = spark.createDataFrame([(i // 2, u, "h", "v") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    got = url_filter.filter_urls(frame, rules, trie_bytes=trie_bytes).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(((i // 2, *brute_rule(u, rules)) for i, u in enumerate(URLS)), key=key)
    assert url_filter.filter_urls(frame.limit(0), rules, trie_bytes=trie_bytes).count() == 0


def vector_rows():
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2):
        centre = rng.normal(size=8)
        for i in range(60):
            spread = 0.02 if i % 3 else 0.3
            rows.append((1000 * label + i, label, (centre + spread * rng.normal(size=8)).tolist()))
        rows += [(1000 * label + 100 + i, label, rng.normal(size=8).tolist()) for i in range(40)]
    # A path of near vectors whose ends are far apart.
    rows += [(3000 + i, 3, [math.cos(0.15 * i), math.sin(0.15 * i)]) for i in range(15)]
    copy = rng.normal(size=8).tolist()
    rows += [(4000 + i, 4, [x * (i + 1) for x in copy]) for i in range(30)]
    rows += [(5000, 4, None), (5001, 4, []), (5002, 4, [0.0] * 8), (5003, 4, [float("nan")] * 8), (5004, None, copy)]
    rows += [(5005, 4, [None, *copy[1:]]), (5006, 4, [float("inf"), *copy[1:]]), (None, 4, copy), (5007, 4, copy[:4]), (5008, 9, copy)]
    return rows


@pytest.mark.parametrize("chunk", [1024, 16])
def test_cover_trees_find_exactly_the_near_pairs(spark, chunk):
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, 5) for r in [*rows, rows[0]]], "vec_id long, label int, embedding array<double>, n_links int")
    got = {r.vec_id: r for r in cover_tree.near_duplicates(frame, 0.98, chunk).collect()}
    sound = {i: (l, np.array(v)) for i, l, v in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: set() for i, _, _ in rows}
    for i, (l, v) in sound.items():
        for j, (m, w) in sound.items():
            if i != j and l == m and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98:
                links[i].add(j)
    for i in links:
        seen, open_ids = {i}, [i]
        while open_ids:
            for j in links[open_ids.pop()] - seen:
                seen.add(j)
                open_ids.append(j)
        root = i if i is None else min(seen)
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), root, i is not None and root == i)
    assert len(got) == len(links)
    assert cover_tree.near_duplicates(frame.limit(0), 0.98, chunk).count() == 0


def test_a_cover_tree_is_nested_and_covers():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(300, 3))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    levels, order = cover_tree.build_tree(points)
    assert sorted(order.tolist()) == list(range(300))
    for depth, level in enumerate(levels):
        start = np.append(0, np.cumsum(level.size))
        assert start[-1] == 300
        for k, centre in enumerate(level.centre):
            inside = order[start[k] : start[k + 1]]
            away = np.linalg.norm(points[inside] - points[centre], axis=1)
            assert centre in inside and away.max() <= level.radius[k] + 1e-7
            assert level.radius[k] <= 2.0 ** (1 - depth) + 1e-7
        if depth:
            assert set(levels[depth - 1].centre) <= set(level.centre)
