"""Chained remaps against a plain walk along random maps."""

import math
import random

import pytest

from kempt.operators import chains


def frame(spark, pairs, schema="source_id long, target_id long"):
    return spark.createDataFrame(pairs, schema)


def walk(pairs):
    moves = {s: t for s, t in pairs if s is not None and s != t}
    out = {}
    for s in moves:
        seen, at = [s], moves[s]
        while at in moves and at not in seen:
            seen.append(at)
            at = moves[at]
        if at in moves:
            ring = seen[seen.index(at):]
            out[s] = (None, None, min(ring), s in ring)
        else:
            out[s] = (at, len(seen), None, False)
    return out


def check(spark, pairs):
    found = chains.resolve_chains(frame(spark, pairs))
    assert {r[0]: tuple(r[1:]) for r in found.report().collect()} == walk(pairs)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_random_maps(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([5, 40, 120])
    check(spark, [(i, rng.randrange(n)) for i in rng.sample(range(n), rng.randrange(n // 2, n))])


def test_joins_grow_with_the_logarithm(spark):
    for n in (3, 30, 300):
        found = check(spark, [(i + 1, i) for i in range(n)])
        assert found.rounds <= math.ceil(math.log2(n)) + 2 and found.n_cyclic == 0


def test_rings_tails_null_targets_repeats_and_self_maps(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (4, 3), (5, 4), (6, None), (7, 6), (8, 8), (9, 9), (None, 1), (10, 11), (10, 11)]
    found = check(spark, pairs)
    assert found.n_cyclic == 5


def test_empty_map_and_conflicts(spark):
    assert chains.resolve_chains(frame(spark, [])).report().count() == 0
    for pairs in ([(1, 2), (1, 3)], [(1, 2), (1, None)]):
        with pytest.raises(ValueError, match="more than one target"):
            chains.resolve_chains(frame(spark, pairs))


def test_children_move_once_and_a_shared_end_is_no_burden(spark):
    pairs = [(i, 0) for i in range(1, 200)] + [(1000, 1001), (1001, 1000)]
    children = frame(spark, [(i, i % 200) for i in range(1000)] + [(2000, 1000), (2001, None)], "c long, fk long")
    found = chains.resolve_chains(frame(spark, pairs))
    assert found.rounds <= 3
    for bound in (10_000, 0):
        assert {(r.c, r.fk) for r in found.remap(children, "fk", bound).collect()} == {(i, 0) for i in range(1000)} | {(2000, 1000), (2001, None)}


@pytest.mark.parametrize("seed", range(3))
def test_maps_in_sequence(spark, seed):
    rng = random.Random(seed)
    maps = [[(s, rng.choice([rng.randrange(30), None])) for s in rng.sample(range(30), 12)] for _ in range(rng.randrange(1, 6))]
    want = {}
    for i in range(30):
        at = i
        for m in maps:
            at = dict(m).get(at, at) if at is not None else None
        if at != i:
            want[i] = at
    got = chains.compose_in_sequence([frame(spark, m) for m in maps])
    assert {r.source_id: r.target_id for r in got.collect()} == want
