"""Hard negatives, the cuckoo index of exact dedup, and the Merkle manifest, each against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import exact_dedup, hard_negatives, manifest
from staylens.llm.exact_dedup import CuckooIndex
from staylens.llm.manifest import Frontier

# -- hard negatives


@pytest.mark.parametrize("bound", [1, 300, 1 << 20])
def test_packed_products_are_exact(bound):
    rng = np.random.default_rng(bound)
    x = rng.integers(-bound, bound + 1, (333, 17))
    x[0], x[1], x[2] = bound, -bound, 0
    packed = hard_negatives.Packed(x, bound)
    for anchor in (*rng.integers(-bound, bound + 1, (20, 17)), np.full(17, bound), np.full(17, -bound), np.zeros(17, np.int64)):
        assert (packed.scores(anchor) == x @ anchor).all()
    assert hard_negatives.Packed(np.zeros((0, 3), np.int64), bound).scores(np.ones(3, np.int64)).tolist() == []


def vectors(spark, rows):
    return spark.createDataFrame([(*r, -1, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, row int, x string")


def mined(rows):
    """By its definition, on (id, vector, label)."""
    v = []
    for at, (i, x, label) in enumerate(rows):
        if x is None or label is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        v.append((at, i, label, [int(np.floor(256 * float(np.float32(c)))) for c in x]))
    order = lambda s, i: (-s, i is None, i or 0)
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for at, i, label, x in v:
        if i is None or i % 100:
            continue
        scored = sorted(((dot(x, y), j, other, k) for k, j, other, y in v if k != at), key=lambda r: order(r[0], r[1]))
        for p, j, _, _ in [r for r in scored if r[2] == label][:5]:
            fit = [r for r in scored if r[2] != label and 30 * p <= 100 * r[0] <= 90 * p][:10]
            out += [(i, j, k, r[1], p, r[0]) for k, r in enumerate(fit, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"block": 2, "chunk_rows": 7}])
def test_hard_negatives_equal_the_definition(spark, sizes):
    rng = np.random.default_rng(3)
    rows = [(i * 10, [float(c) for c in rng.normal(0.1, 0.2, 8)], int(rng.integers(0, 4))) for i in range(120)]
    same = [0.25] * 8
    rows += [(1300 + i, same, i % 3) for i in range(40)]  # ties
    rows += [(100, same, 1), (100, same, 1), (100, rows[3][1], 2), (None, same, 0), (None, same, 1)]  # repeated and NULL keys
    rows += [(200, None, 1), (300, [1.0, None] * 4, 1), (400, [float("nan")] * 8, 1), (500, [float("inf")] * 8, 2), (600, same, None)]
    rows += [(1700, [0.5], 1), (1800, [], 1), (1900, [-0.5] * 8, 2)]
    got = hard_negatives.mine(vectors(spark, rows), F.col("id") % 100 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows)
    assert len(want) > 300 and sorted(map(tuple, got.collect()), key=str) == want


def test_hard_negatives_without_rows_or_with_huge_ones(spark):
    assert hard_negatives.mine(vectors(spark, []), F.col("id") % 100 == 0).count() == 0
    assert hard_negatives.mine(vectors(spark, [(0, [1.0], 1)]), F.col("id") % 100 == 0).count() == 0
    assert hard_negatives.mine(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)]), F.col("id") % 100 == 0).count() == 0
    with pytest.raises(ValueError, match="long"):
        hard_negatives.mine(vectors(spark, [(0, [1e30], 1)]), F.col("id") % 100 == 0)


# -- exact dedup


def test_cuckoo_index_under_insertion_and_deletion():
    rng, index, live = random.Random(1), CuckooIndex(2), {}
    names = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for step in range(20_000):
        d = rng.choice(names)
        if rng.random() < 0.6:
            assert index.insert(d, step) == live.setdefault(d, step)
        else:
            assert index.delete(d) == (live.pop(d, None) is not None)
        if step % 1000 == 0:
            assert dict(index.items()) == live and index.live == len(live)
    assert all(index.find(d) == live.get(d) for d in names)


def test_equal_marks_are_told_apart_by_content():
    index, same = CuckooIndex(), b"\x07\x00"
    names = [same + i.to_bytes(8, "little") + b"x" * 22 for i in range(800)]
    for i, d in enumerate(names[:400]):
        index.insert(d, i)
    assert [index.find(d) for d in names] == [*range(400), *[None] * 400]
    assert index.buckets > 64  # what had no place made it grow
    assert all(index.delete(d) for d in names[:100]) and index.live == 300
    assert [index.find(d) for d in names[:400]] == [*[None] * 100, *range(100, 400)]


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("live", [3, exact_dedup.LIVE])
def test_decisions_equal_brute_force(table, odd_texts, live):
    texts = odd_texts + ["a b", "a \t\n b", " a b", "a b", "a b", "  ", "\n", "A b"] + ["same  text"] * 50 + ["x " * 200_000, "x\n" * 200_000]
    ids = [*range(100, 100 + len(texts) - 4), 3, 3, None, None]
    rows = list(zip(ids, texts))
    got = exact_dedup.decide(table(texts, ids).repartition(3), live=live).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    want = []
    for t, members in groups.items():
        least = min((i for i in members if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        want += [(i, least, len(members), sha) for i in members]
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == sorted(want, key=str)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept}) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_dedup.decide(table([])).count() == 0


def test_changes_of_the_live_index(spark, table):
    rng, live, held = random.Random(2), None, []
    for step in range(3):
        new = [(rng.randrange(40), rng.choice(["a", "b ", "c", None])) for _ in range(60)]
        gone = [(i, t) for i, t in held if rng.random() < 0.3] + [(99, "never there")]
        inserts, deletes = (exact_dedup.digests(table([t for _, t in x], [i for i, _ in x])) for x in (new, gone))
        live = live if live is not None else inserts.limit(0).withColumn("copies", F.lit(0))
        live = spark.createDataFrame(exact_dedup.changed(live, inserts, deletes).collect(), "digest binary, doc_id bigint, copies bigint")
        for x in gone:
            if x in held:
                held.remove(x)
        held += new
        want = {}
        for i, t in held:
            want.setdefault(hashlib.sha256(normal(t).encode()).digest(), []).append(i)
        got = {bytes(r["digest"]): (r["keep_id"], r["group_size"]) for r in exact_dedup.live_groups(live).collect()}
        assert got == {d: (min(m), len(m)) for d, m in want.items()}


# -- manifest


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def tree(leaves):
    """All levels, as hex."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        a = i - i % 2
        out.append((level[a:i], level[i + 1 : a + 2]))
        i //= 2
    return out


def fold(leaf, path):
    for left, right in path:
        leaf = sha(*left, leaf, *right)
    return leaf


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 64, 100])
def test_partial_witnesses_grow_into_whole_ones(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    frontier = Frontier()
    for i, leaf in enumerate(leaves):
        frontier.append(leaf)
        assert all(len(w) <= max(1, i.bit_length()) for w in frontier.witnesses)
    root, levels = frontier.close(), tree([x.hex() for x in leaves])
    assert root.hex() == levels[-1][0]
    for i, leaf in enumerate(leaves):
        whole = b"".join(frontier.witnesses[i])
        assert manifest.folded(leaf, whole) == root
        assert manifest.proof(whole) == sha(*[x for left, right in siblings(levels, i) for x in (*left, *right)])


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows, bad):
    leaf = lambda r, more=0: sha(*map(enc, (r[0], r[3], r[2], r[4] if r[4] is None else r[4] + more, r[1])))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            path = siblings(trees[g], i) + siblings(top, k)
            end = fold(leaf(r, 1 if bad(r) else 0), path)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha(*[x for a, b in path for x in (*a, *b)]), end, end == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [2, 4, 1024])
def test_manifest_equals_brute_force(spark, odd_texts, block):
    rng = random.Random(block)
    rows = [(i, t, rng.choice(["en", "de", None, "é", "z"]), "s", len(t or "")) for i, t in enumerate(odd_texts)]
    rows += [(100 + i, f"text {i}", "en" if i % 3 else "fr", None if i % 5 else "w", None if i % 7 == 3 else i) for i in range(60)]
    rows += [(7, "again", "en", "s", 1), (7, "again", "en", "s", 1), (7, "other", "en", "s", 1), (None, None, None, None, None), (None, "x", "en", "", 2), (5000, "alone", "only", "s", 5)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, b"x", 1, "y") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, node binary, grp int, witness string")
    got = manifest.manifest(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, block=block)
    bad = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
    want = brute(rows, bad)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(not w[-1] for w in want) == sum(map(bad, rows)) > 5


def test_manifest_of_one_group_and_of_nothing(table):
    for n in range(4):
        got = manifest.manifest(table([f"t{i}" for i in range(n)]), block=2).collect()
        assert len(got) == n and all(r["verified"] and r["root"] == r["subroot"] for r in got)
    assert len(set(itertools.chain(*[[r["leaf"] for r in got]]))) == 3
