import random
import tracemalloc

import numpy as np
import pytest
import xxhash
from lattica.llm import graph, simhash
from lattica.llm.common import table
from tests.llm.helpers import AWKWARD, docs


def slow_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def expected(rows, bits=4):
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in fps})
    comp = slow_components(distinct, lambda a, b: (a ^ b).bit_count() <= bits)
    least = {}
    for i, f in fps:
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    return sorted((i or 0, f, least.get(comp[f]) or 0) for i, f in fps)


def result(df, **options):
    return sorted((r.doc_id or 0, r.fp % (1 << 64), r.component_id or 0) for r in simhash.near_duplicates(df, **options).collect())


@pytest.mark.parametrize(("max_bucket", "hot_keys"), [(4, 3), (simhash.MAX_BUCKET, 8), (simhash.MAX_BUCKET, simhash.HOT_KEYS)])
def test_awkward_and_near_copies(spark, max_bucket, hot_keys):
    random.seed(1)
    base = [random.choice(["alpha", "beta", "gamma", "delta", "Eps", "zeta"]) + str(random.randrange(99)) for _ in range(300)]
    rows = list(AWKWARD)
    for k in range(60):
        words = list(base)
        for _ in range(k % 4):
            words[random.randrange(300)] = "changed" + str(k)
        rows.append((100 + k, " ".join(words)))
    assert result(docs(spark, rows, fp=1, component_id="x", text_hash=3), max_bucket=max_bucket, hot_keys=hot_keys) == expected(rows)


def test_real_documents(spark, sf):
    df = table(spark, sf, "documents")
    assert result(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_links_find_every_distance_up_to_four(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(-(2**63), 2**63 - 1, 200)
    fps = {int(b) for b in base}
    for b in base:
        for d in range(1, 6):
            x = int(b)
            for bit in rng.choice(64, d, replace=False):
                x ^= (1 << int(bit)) if bit < 63 else -(1 << 63)
            fps.add(x)
    fps = sorted(fps)
    for max_bucket in (3, 1000):
        edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 4, max_bucket)
        assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 4 for r in edges.collect())
        got = {r.node: r.root for r in graph.components(edges).collect()}
        want = slow_components(fps, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
        assert {x: got.get(x, x) for x in fps} == want


def test_buckets_of_near_copies_hold_no_pairs():
    """Sixteen buckets of 1,000 members that all link: 8 million pairs, of which only spanning edges are held."""
    rng = np.random.default_rng(6)
    fps = rng.integers(-(2**62), 2**62, 16).repeat(1000) ^ (1 << rng.integers(0, 60, 16_000))
    members = np.stack([np.arange(16_000), fps], axis=1)
    tracemalloc.start()
    u, v = simhash._linked_in_buckets(np.arange(16).repeat(1000), members, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    assert len(u) == 16 * 999 and np.array_equal(u // 1000, v // 1000)


@pytest.mark.parametrize("bits", [0, 1, 3, 8])
def test_links_within_buckets_equal_all_pairs(bits):
    rng = np.random.default_rng(bits)
    key = np.sort(rng.integers(0, 40, 300))
    members = np.stack([np.arange(300), rng.integers(0, 256, 300)], axis=1)
    joined = {(min(a, b), max(a, b)) for a, b in zip(*(x.tolist() for x in simhash._linked_in_buckets(key, members, bits)))}
    linked = lambda a, b: key[a] == key[b] and int(members[a, 1] ^ members[b, 1]).bit_count() <= bits
    assert all(linked(a, b) for a, b in joined)
    assert slow_components(list(range(300)), lambda a, b: (a, b) in joined) == slow_components(list(range(300)), linked)


def test_a_forest_joins_each_tree_once():
    rng = np.random.default_rng(3)
    u, v = rng.integers(0, 60, 400), rng.integers(0, 60, 400)
    for limit in (10**6, 5):
        forest, kept = simhash.Forest(limit), []
        for i in range(0, 400, 20):
            new = forest.joining(u[i : i + 20], v[i : i + 20])
            kept += list(zip(u[i : i + 20][new].tolist(), v[i : i + 20][new].tolist()))
        pairs = lambda es: slow_components(list(range(60)), lambda a, b, es=set(es): (a, b) in es or (b, a) in es)
        assert pairs(kept) == pairs(zip(u.tolist(), v.tolist()))
        assert limit == 5 or len(kept) < 60


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 150)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 150)}, **{200 + i: 200 for i in range(9)}}


def test_one_row_of_each_component_stays(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "other words stand here now"), (None, "only here without id"), (None, "only here without id"), (None, "a b c d e f"), (11, None), (12, "")]
    clashing = {"_nth": 7, "_id": "x", "_hash": 1, "_own": "kept", "row": 3, "node": 4, "own": "o", "words": "w"}
    left = simhash.deduplicated(docs(spark, rows, **clashing))
    assert left.columns == [*docs(spark, []).columns, *clashing]
    left = left.collect()
    assert sorted((r.doc_id or 0, r.text) for r in left if r.text) == [(0, "only here without id"), (3, "a b c d e f"), (9, "other words stand here now")]
    assert sum(not r.text for r in left) == 1 and all({k: r[k] for k in clashing} == clashing for r in left)


def test_groups_that_share_an_id_leave_a_row_each(spark):
    one, two = "first cluster of words " * 9, "the second one is quite another text"
    left = simhash.deduplicated(docs(spark, [(5, one), (5, two), (6, one), (7, two), (5, one)])).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted([(5, one), (5, two)])


def word_sets(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar_groups(rows, similarity=0.8):
    """The smallest root of each row by exact similarity of all pairs."""
    sets = [word_sets(t) for _, t in rows]

    def linked(i, j):
        a, b = sets[i], sets[j]
        return a == b or bool(a and b) and len(a & b) >= similarity * len(a | b) - 1e-9

    return slow_components(list(range(len(rows))), linked)


def edited(rng, words, share):
    return [w if rng.random() > share else f"new{rng.random()}" for w in words]


@pytest.mark.parametrize("options", [{}, {"max_bucket": 4, "max_shingles": 500, "hot_keys": 3}])
def test_groups_of_near_copies_equal_brute_force(spark, options):
    rng = random.Random(4)
    rows = list(AWKWARD)
    for k in range(8):  # groups from 2 to 9, half the copies almost at the threshold
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 200, 900]))]
        rows += [(100 + 10 * k + i, " ".join(edited(rng, base, 0.001 if i % 2 else 0.012))) for i in range(2 + k)]
    rng.shuffle(rows)
    groups = similar_groups(rows)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        key = (doc_id is None, doc_id or 0, i)
        first[groups[i]] = min(key, first.get(groups[i], key))
    got = simhash.deduplicated(docs(spark, rows).coalesce(1), **options)
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted((k[1], rows[k[2]][1] or "") for k in first.values())


def test_share_of_pairs_found_by_similarity(spark):
    """Pairs just over the threshold are gathered with a probability of 0.9, closer ones nearly always; none below it."""
    rng = random.Random(5)
    rows, truth = [], {}
    for k in range(400):
        base = [f"w{rng.randrange(9000)}" for _ in range(300)]
        other = edited(rng, base, rng.choice([0.005, 0.012, 0.02, 0.03]))
        a, b = word_sets(" ".join(base)), word_sets(" ".join(other))
        truth[2 * k + 1] = len(a & b) / len(a | b)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    left = {r.doc_id for r in simhash.deduplicated(docs(spark, rows)).collect()}
    found = lambda lo, hi: [i not in left for i, j in truth.items() if lo <= j < hi]
    assert not any(found(0, 0.7999))
    assert np.mean(found(0.8, 0.85)) > 0.85 and np.mean(found(0.85, 0.9)) > 0.93 and np.mean(found(0.9, 1.01)) > 0.97


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    assert simhash.deduplicated(docs(spark, [])).collect() == []
