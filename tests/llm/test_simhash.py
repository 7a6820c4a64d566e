import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from gaugewright.llm.queries import op7_simhash_near_dedup
from gaugewright.llm.simhash import (
    bucket_links, components, covering_masks, finer_masks, fingerprint, near_dedup, near_groups, near_links,
)
from tests.llm.rows import AWKWARD, documents


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """{fingerprint: least fingerprint it reaches}, by comparing all pairs."""
    left, out = sorted(set(prints)), {}
    while left:
        root, todo = left[0], [left.pop(0)]
        while todo:
            at = todo.pop()
            out[at] = root
            near = [f for f in left if (f ^ at).bit_count() <= radius]
            left = [f for f in left if (f ^ at).bit_count() > radius]
            todo += near
    return out


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    roots, least = plain_components(prints), defaultdict(list)
    for (i, _), f in zip(rows, prints):
        least[roots[f]].append(i)
    return sorted(
        (repr(i), f"{f:016x}", min((x for x in least[roots[f]] if x is not None), default=None))
        for (i, _), f in zip(rows, prints))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "A B c", "A b C d", "x\x0by z\x1c w Élan É " * 9, "a " * 40000])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_masks_cover_every_pair_within_the_radius():
    masks = [m & (2 ** 64 - 1) for m in covering_masks()]
    assert len(masks) == 31 and all(20 < m.bit_count() < 44 for m in masks)
    chance = random.Random(1)
    for _ in range(3000):
        differ = sum(1 << b for b in chance.sample(range(64), chance.randint(1, 4)))
        assert any(not m & differ for m in masks)


def flips(chance, value, n):
    for b in chance.sample(range(64), n):
        value ^= 1 << b
    return value


def some_prints(seed):
    chance = random.Random(seed)
    prints = {0}
    for _ in range(60):
        at = chance.getrandbits(64)
        for _ in range(chance.choice([1, 1, 2, 8])):
            prints.add(at)
            at = flips(chance, at, chance.randint(1, 6))  # chains, some of them torn
    centre = chance.getrandbits(64)
    prints |= {flips(chance, centre, 2) for _ in range(200)}
    return sorted(prints)


def test_bucket_links_connect_what_is_near():
    prints = some_prints(3)
    a, b = bucket_links(np.array(prints, np.uint64), 4)
    assert len(a) < len(prints)
    assert all((int(x) ^ int(y)).bit_count() <= 4 for x, y in zip(a, b))
    roots, up = plain_components(prints), {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in zip(a, b):
        x, y = sorted((find(int(x)), find(int(y))))
        up[y] = x
    assert {p: find(p) for p in prints} == roots


def test_links_and_components_equal_all_pairs(spark):
    prints = some_prints(7)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = near_links(spark.createDataFrame(signed, "fingerprint long"))
    groups = defaultdict(set)
    for row in components(links).collect():
        groups[row["root"]].add(row["node"] & (2 ** 64 - 1))
    want = defaultdict(set)
    for f, root in plain_components(prints).items():
        want[root].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_finer_tables_cover_the_free_bits():
    chance, masks = random.Random(2), covering_masks()
    finer = defaultdict(list)
    for table, number, mask in finer_masks():
        finer[table].append(mask)
        assert mask & masks[table] == masks[table]
    assert len({n for _, n, _ in finer_masks()}) == 31 * 31
    for table, mask in enumerate(masks):
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(60):
            differ = sum(1 << b for b in chance.sample(free, chance.randint(1, 4)))
            assert any(not m & differ for m in finer[table])


@pytest.mark.parametrize("largest", [1, 3, 40])
def test_crowded_buckets_lose_no_link(spark, largest):
    """Many fingerprints that agree on the first table's bits, in small batches, so that buckets go on over batches."""
    chance, mask = random.Random(largest), covering_masks()[0]
    fixed = chance.getrandbits(64) & mask
    prints = {fixed | (chance.getrandbits(64) & ~mask & (2 ** 64 - 1)) for _ in range(700)}
    prints |= {flips(chance, p, chance.randint(1, 4)) for p in list(prints)[:80]} | set(some_prints(9))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "90")
    try:
        links = near_links(spark.createDataFrame(signed, "fingerprint long"), largest=largest).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert all((r["a"] ^ r["b"]).bit_count() <= 4 or ((r["a"] ^ r["b"]) & (2 ** 64 - 1)).bit_count() <= 4 for r in links)
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = defaultdict(set)
    for row in rows:
        groups[row["root"]].add(row["node"] & (2 ** 64 - 1))
    want = defaultdict(set)
    for f, root in plain_components(prints).items():
        want[root].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_a_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(300)], "a long, b long")
    rows = components(links).collect()
    assert len(rows) == 301 and {r["root"] for r in rows} == {0}


def test_awkward_rows(spark):
    rows = AWKWARD + [(50 + i, f"near copy number of this text {'with the same long tail ' * 30} {i}", "a") for i in range(6)]
    docs = documents(spark, rows)
    groups = near_groups(docs).collect()
    got = sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in groups)
    assert got == expected([(i, t) for i, t, _ in rows])
    kept = near_dedup(docs)
    assert kept.schema == docs.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(repr, ids)) == sorted(map(repr, {r["component_id"] for r in groups}))
    assert near_groups(docs.limit(0)).count() == 0 and near_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_all_pairs(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = op7_simhash_near_dedup(spark, f"/root/testdata/{sf}").collect()
    got = sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows)
    assert got == expected([tuple(d) for d in docs])
