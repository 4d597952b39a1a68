"""SimHash linking against all pairs, hot buckets, and one row of each group."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from isobar.llm import simhash
from cases import DOCS, documents, empty_documents, odd_documents, odd_rows


def fingerprint(text, size=simhash.SHINGLE):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius=simhash.RADIUS):
    """Fingerprint -> smallest fingerprint of its component, from all pairs."""
    distinct = np.unique(np.array(values, np.uint64))
    root = {int(v): int(v) for v in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for v in distinct:
        for w in distinct[np.bitwise_count(distinct ^ v) <= radius]:
            a, b = sorted((find(int(v)), find(int(w))))
            root[b] = a
    return {v: find(v) for v in root}


def check(rows, got):
    prints = {k: fingerprint(t) for k, (_, t) in enumerate(rows)}
    group = classes(list(prints.values()))
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = group[prints[k]]
            low[r] = min(low.get(r, i), i)
    want = sorted((str(i), prints[k], str(low.get(group[prints[k]]))) for k, (i, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == want


def test_components_equal_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    check(rows, simhash.near_duplicate_components(documents(spark)).collect())


def test_odd_rows_and_clashing_columns(spark):
    got = simhash.near_duplicate_components(odd_documents(spark, "fp", "low", "root", "component_id"))
    check([r[:2] for r in odd_rows()], got.collect())


def test_empty_table(spark):
    assert simhash.near_duplicate_components(empty_documents(spark)).count() == 0
    assert simhash.one_of_each(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("block", [7, 4096])
def test_links_connect_what_all_pairs_connect(spark, block):
    """A dense group in one bucket, cut into blocks, and background."""
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    near = [int(centre) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False))) for _ in range(150)]
    values = list({*near, *rng.integers(0, 1 << 63, 300).tolist()})
    nodes = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    plan = simhash.choose_partitions(np.array(values, np.uint64), len(values))
    edges = simhash.links(nodes, plan, block=block)
    assert edges.count() < len(values) * 40
    pairs = [(r.u % (1 << 64), r.v % (1 << 64)) for r in edges.collect()]
    assert all((u ^ v).bit_count() <= simhash.RADIUS for u, v in pairs)
    roots = {r.node % (1 << 64): r.root for r in simhash.components(edges).collect()}
    group = classes(values)
    for v in values:
        for w in values:
            if v in roots and w in roots:
                assert (roots[v] == roots[w]) == (group[v] == group[w])
    linked = {v for v in values if sum(group[w] == group[v] for w in values) > 1}
    assert linked == set(roots)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=40), st.integers(1, 6))
def test_plan_obeys_the_pigeonhole_principle(values, radius):
    plan = simhash.choose_partitions(np.array(values, np.uint64), 1_000_000, radius)
    used = sorted(b for group, _ in plan for b in group)
    assert len(set(used)) == len(used) and set(used) <= set(range(64))
    # sum of (threshold + 1) over all partitions, left-out ones adding 0, exceeds the radius.
    assert sum(t + 1 for _, t in plan) == radius + 1


def test_wider_tables_get_wider_partitions():
    sample = np.random.default_rng(3).integers(0, 1 << 63, 500).astype(np.uint64)
    narrow, wide = (simhash.choose_partitions(sample, n) for n in (10_000, 1_000_000_000))
    assert len(wide) < len(narrow) and sum(t for _, t in wide) > sum(t for _, t in narrow)


def test_path_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    assert simhash.components(edges).select("root").distinct().count() == 1


def test_one_row_of_each_group_with_all_columns(spark):
    docs = odd_documents(spark, "root", "first")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    groups = classes([fingerprint(r[1]) for r in odd_rows()])
    by_group = {}
    for r in odd_rows():
        key = groups[fingerprint(r[1])]
        order = (r[0] is None, r[0] or 0)
        by_group[key] = min(by_group.get(key, order), order)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted(by_group.values())


def test_equal_rows_leave_one(spark):
    rows = [(7, "one two three four five six", "en", "a", 1)] * 5
    assert simhash.one_of_each(spark.createDataFrame(rows, DOCS).repartition(3)).count() == 1


def test_extra_columns_of_any_type_and_name(spark):
    from pyspark.sql import functions as F

    docs = odd_documents(spark).withColumns({
        "a.b": F.lit(1), "m": F.create_map(F.lit("k"), F.col("doc_id")), "_row_key_ID": F.lit("x"), "tick`ed": F.lit(2),
        "deep": F.array(F.struct(F.create_map(F.lit(1), F.lit(2)).alias("inner"))),
    })
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert got.count() == simhash.one_of_each(odd_documents(spark)).count()
