"""Operators that hold texts against each other: spans, sketches, SimHash, decontamination, revisits, the pipeline."""

import hashlib
import itertools
import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from staylens.llm import components, decontaminate, language, nearness, pii, revisit, simhash, sketches, substring
from staylens.llm.shared import keyed_texts, maybe_among

from .conftest import LINES


def words(n, seed):
    rng = random.Random(str(seed))
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def edited(text, n, seed):
    w, rng = text.split(), random.Random(seed)
    for i in rng.sample(range(len(w)), n):
        w[i] += "zz"
    return " ".join(w)


def runs(text, n=5):
    w = text.split()
    return {tuple(w[i : i + min(n, len(w))]) for i in range(len(w) - min(n, len(w)) + 1)} if w else set()


# -- substring dedup


def test_sentences_are_all_of_the_text():
    for t in ["", "a", "A b. C d! E\nf\n\n g?? h", " x. ", "\n", "  " + "a  b " * 40, " ".join(words(300, 1)), "\ud800 " * 30]:
        assert "".join(substring.sentences(t)) == t


def test_repeats_go_but_the_first(spark, table):
    passage = " ".join(LINES[:2])
    own = [". ".join(" ".join(words(9, (i, j))) for j in range(6)) + "." for i in range(4)]
    texts = [own[0], f"{own[1]}\n{passage}\n{own[1][::-1]}", f"{own[2]} {passage} {own[3]}", f"{passage}\nend here. {passage}", None, "", "short one. two.", LINES[2], LINES[2]]
    out = {r["doc_id"]: r for r in substring.without_repeats(table(texts)).collect()}
    assert out.keys() == {2, 3, 8}
    assert all(s not in out[2]["text"] for s in LINES[:2]) and own[2] in out[2]["text"] and own[3] in out[2]["text"]
    assert LINES[0] not in out[3]["text"] and "end here." in out[3]["text"] and out[3]["kept_in"] == [1]
    assert out[8]["text"] == "" and out[8]["kept_in"] == [7]
    for r in out.values():
        cut = texts[r["doc_id"]]
        for span in reversed(r["removed"]):
            cut = cut[: span["first"]] + cut[span["upto"] :]
        assert cut == r["text"]
    assert substring.without_repeats(table([])).count() == 0


def test_repeats_equal_brute_force(table, odd_texts):
    rng = random.Random(4)
    pool = [" ".join(words(rng.randint(1, 30), k)) + rng.choice([".", "!", "\n"]) for k in range(25)]
    texts = odd_texts + [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    first, gone = {}, {}
    for i, t in enumerate(texts):
        s = substring.sentences(t or "")
        for a in range(len(s)):
            ends, n = [], 0
            for b in range(a + 1, len(s) + 1):
                n += len(s[b - 1].split())
                if n >= 25 and (b - a >= 2 or n >= 50):
                    ends = [b]
                    break
            if ends and s[a].split():
                key = "\n".join(" ".join(x.lower().split()) for x in s[a : ends[0]])
                if first.setdefault(key, (i, a)) != (i, a):
                    gone.setdefault(i, set()).update(range(a, ends[0]))
    want = {i: "".join(x for k, x in enumerate(substring.sentences(texts[i])) if k not in g) for i, g in gone.items()}
    assert {r["doc_id"]: r["text"] for r in substring.without_repeats(table(texts)).collect()} == want


def test_passages_without_sentence_ends_are_found(table):
    def inside(passage, *seed):
        return f"{' '.join(words(20 + seed[0] % 9, (seed, 0)))} {passage} {' '.join(words(25, (seed, 1)))}"

    filler = " ".join(["the"] * 60)
    texts = [inside(filler, 1, "f"), inside(filler, 2, "f")]
    texts += [inside(" ".join(words(51, ("p", i))), i, copy) for copy in "ab" for i in range(40)]
    texts += [" ".join(words(200, ("own", i))) for i in range(5)]
    out = {r["doc_id"]: r for r in substring.without_repeats(table(texts)).collect()}
    assert out[1]["text"].split().count("the") <= 2  # the outer ones lie in pieces with the words beside them
    assert all(k in (0, 1) or 42 <= k < 82 for k in out)  # 0 repeats its own filler
    found = [i for i in range(40) if i + 42 in out]
    assert len(found) >= 37  # the shortest passages, of 51 words; where cuts lie is chance
    for i in found:
        left, passage = out[i + 42]["text"].split(), words(51, ("p", i))
        assert len(left) <= len(texts[i + 42].split()) - substring.MIN_WORDS
        assert [w for w in texts[i + 42].split() if w not in passage and w not in left] == []


def test_rows_of_one_key(table):
    text = " ".join(LINES)
    same = substring.without_repeats(table([text, text], [5, 5]))
    assert same.count() == 0  # one document, given twice
    other = substring.without_repeats(table([text, text + " More."], [None, None])).collect()
    assert len(other) == 1 and other[0]["doc_id"] is None


# -- sketches


def test_fingerprints_equal_the_definition(table, odd_texts):
    texts = odd_texts + [" ".join(words(300, i)) for i in range(3)]
    out = {r["doc_id"]: r for r in sketches.fingerprints(table(texts)).collect()}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        after = plain[(i + 1) % len(plain)]
        half = len(t) // 2
        edit = t[: len(t) - half] + after[:half]
        assert out[i]["n_chars"] == len(t) and out[i]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        for other, name in ((edit, "near_edited"), (after, "near_next")):
            a, b = runs(t), runs(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert out[i][name] == pytest.approx(exact, abs=1e-12 if len(a | b) <= sketches.K else 0.13)
        assert (out[i]["fingerprint"] == out[i]["edited_fingerprint"]) == (out[i]["near_edited"] == 1.0)
    assert out[4]["fingerprint"] == out[5]["fingerprint"] and out[0]["fingerprint"] == out[1]["fingerprint"] == ""
    assert sketches.fingerprints(table([])).count() == 0


@pytest.mark.parametrize("ids", [[0, 1, 2, 3, 4], [-(2**62), 5, 2**62, 6, 7], [None, 3, 3, 3, 9], [1]])
def test_next_text_for_any_keys(table, ids):
    texts = [f"t{i}" for i in range(len(ids))]
    rows = sketches.with_next(keyed_texts(table(texts, ids)), ranges=3, bucket=1)
    order = sorted(zip(ids, texts), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = sorted((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    assert sorted((r["text"], r["next_text"]) for r in rows.collect()) == want


def test_next_text_of_many_sparse_keys(table):
    rng = random.Random(8)
    ids = rng.sample(range(-(10**12), 10**12), 150) + list(range(50))
    rows = sketches.with_next(keyed_texts(table([str(i) for i in ids], ids)), ranges=4, bucket=3)
    order = sorted(ids)
    assert {int(r["text"]): int(r["next_text"]) for r in rows.collect()} == dict(zip(order, order[1:] + order[:1]))


def test_sketches_merge_and_estimate(spark, table):
    text = " ".join(words(3000, 1))
    w = text.split()
    parts = [" ".join(w[i : i + 604]) for i in range(0, 2400, 600)]
    df = sketches.with_sketch(table([*parts, " ".join(w[:2404])]), F.col("text"), "sketch")
    whole = df.where("doc_id = 4").first()["sketch"]
    assert sketches.merged(df.where("doc_id < 4").withColumn("g", F.lit(1)), ["g"]).first()["sketch"] == whole
    n = df.where("doc_id = 4").select(sketches.shingle_count(F.col("sketch"))).first()[0]
    assert abs(n / 2400 - 1) < 0.25
    a, b = df.where("doc_id = 0").select(F.col("sketch").alias("a")), df.where("doc_id = 4").select(F.col("sketch").alias("b"))
    inside = a.crossJoin(b).select(sketches.containment(F.col("a"), F.col("b"))).first()[0]
    assert inside > 0.7


# -- SimHash


def test_fingerprint_equals_the_definition():
    for text in ["", " \t", "One", "A b", "A b c d\x0be\nÉ x", " ".join(words(70_000, 2))]:
        w = text.encode().lower().split()
        n = min(3, len(w))
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(len(w) - n + 1)] if w else []
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("radius", [1, 3, 5])
def test_masks_cover_every_difference(radius):
    found = simhash.masks(list(range(64)), radius)
    assert len(found) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not diff & m for m in found)


def brute_components(values, linked):
    root = list(range(len(values)))
    for i, j in itertools.combinations(range(len(values)), 2):
        if linked(values[i], values[j]):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("bucket", [4096, 3])
def test_near_edges_equal_all_pairs(spark, bucket):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    values = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(14)})
    df = spark.createDataFrame([(simhash.signed(v), 0) for v in values], "bits bigint, check bigint")
    edges = simhash.near_edges(df, simhash.Rule(bucket=bucket)).collect()
    names = {f"{v:016x}{0:016x}": i for i, v in enumerate(values)}
    pairs = {(names[r["a"]], names[r["b"]]) for r in edges}
    want = brute_components(values, lambda a, b: (a ^ b).bit_count() <= 3)
    assert brute_components(list(range(len(values))), lambda a, b: (a, b) in pairs or (b, a) in pairs) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(30)} | {299: 299, 300: 299}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_of_rows(table, odd_texts):
    texts = odd_texts + [edited(" ".join(words(400, 3)), k % 3, k) for k in range(8)]
    out = {r["doc_id"]: r for r in simhash.near_duplicates(table(texts)).collect()}
    bits = [simhash.fingerprint(t or "") for t in texts]
    roots = brute_components(bits, lambda a, b: (a ^ b).bit_count() <= 3)
    assert [(out[i]["fingerprint"], out[i]["component_id"]) for i in range(len(texts))] == [(f"{b:016x}", r) for b, r in zip(bits, roots)]
    assert simhash.near_duplicates(table([])).count() == 0
    nulls = simhash.near_duplicates(table(["a", "a", "b"], [None, 4, None])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in nulls) == [(-1, -1), (-1, 4), (4, 4)]


def test_one_of_each_group_stays(table):
    base = [" ".join(words(200, i)) for i in range(6)]
    texts = base + [edited(t, 2, i) for i, t in enumerate(base)] + [base[0], None, "", "one two"]
    df = table(texts)
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {0, 1, 2, 3, 4, 5, 13, 15}
    assert simhash.representatives(table(["x y", "x y", "x y"], [3, 3, None])).count() == 1
    assert simhash.representatives(table([])).count() == 0


@pytest.mark.parametrize("bucket", [4096, 3])
def test_similar_texts_are_one_class(table, bucket):
    rng = random.Random(11)
    base = [" ".join(words(rng.randint(60, 400), ("n", i))) for i in range(12)]
    texts = base + [edited(t, max(1, int(len(t.split()) * share)), (i, share).__hash__()) for i, t in enumerate(base) for share in (0.015, 0.02, 0.025, 0.03, 0.04, 0.05, 0.06, 0.08)]
    texts += ["", None, "a b", "A  b"]
    sets = [runs((t or "").lower()) for t in texts]
    alike = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b) > 0
    want = brute_components(sets, alike)
    assert len(set(want)) > 24  # some edits go too far
    out = {r["doc_id"]: r["class_name"] for r in nearness.classes(table(texts), bucket=bucket).collect()}
    first = {}
    assert [first.setdefault(bytes(out[i]), i) for i in range(len(texts))] == want


@pytest.mark.parametrize("chunk", [nearness.CHUNK, 2000])
def test_groups_of_copies_lose_no_link(table, chunk):
    """Copies of which some pairs are just below the threshold: a pair that fails must not hide the next one."""
    texts = []
    for g in range(24):
        base = " ".join(words(250, ("group", g)))
        texts += [edited(base, 2 + (g + k) % 9, f"{g}/{k}") for k in range(25)]
    sets = [runs(t) for t in texts]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    want, below = [], 0
    for g in range(24):
        own = sets[g * 25 : g * 25 + 25]
        want += [r + g * 25 for r in brute_components(own, alike)]
        below += sum(not alike(a, b) for a, b in itertools.combinations(own, 2))
    assert below > 1000
    out = {r["doc_id"]: bytes(r["class_name"]) for r in nearness.classes(table(texts), chunk=chunk).collect()}
    first = {}
    assert [first.setdefault(out[i], i) for i in range(len(texts))] == want


def test_filter_of_fixed_size_lets_all_keys_pass(spark):
    keys = spark.range(0, 3000, 7).select(F.col("id").cast("string").alias("k"), (F.col("id") % 5).alias("m"))
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 5).alias("m"), F.lit(1).alias("_bits"))
    out = maybe_among(df, keys, ["k", "m"], "there")
    assert out.columns == ["k", "m", "_bits", "there"]
    passed = {int(r["k"]) for r in out.where("there").collect()}
    assert set(range(0, 3000, 7)) <= passed and len(passed) < 440
    assert maybe_among(df, keys.limit(0), ["k", "m"], "there").where("there").count() == 0


def test_representatives_beside_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 1, 2, 3, 4), (2, "A  b", 1, 2, 3, 4), (None, "c", 1, 2, 3, 4), (None, "c", 5, 2, 3, 4)], "doc_id bigint, text string, _near_key int, _near_null int, _near_digest int, _near_maybe int")
    kept = simhash.representatives(df)
    assert kept.columns == df.columns and sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "c"), (1, "a b")]


@pytest.mark.parametrize("find", [pii.BASE["ip"].findall, substring.sentences, language.visible])
@pytest.mark.parametrize("sign", "1.<! \n")
def test_long_runs_of_one_sign_are_read_once(find, sign):
    start = time.perf_counter()
    find(sign * 400_000)
    assert time.perf_counter() - start < 20  # seconds of quadratic work would be thousands


# -- decontamination


def brute_leaks(texts, items, at_least=0.8):
    import re

    norm = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    parts = {i: grams(norm(t)) for i, t in enumerate(items) if norm(t)}
    held = {}
    for g in parts.values():
        for s in set(g):
            held[s] = held.get(s, 0) + 1
    rare = np.log1p(len(parts))
    out = set()
    for d, t in enumerate(texts):
        w = norm(t)
        for i, g in parts.items():
            n = len(norm(items[i]))
            shingles = grams(w)
            for a in range(-n, len(w)):
                win = shingles[max(a, 0) : max(a + max(n - 4, 1), 0)]
                mine = {s: g.count(s) for s in g}
                if not set(win) & set(g):
                    continue
                weight = {s: np.log1p(len(parts) / held[s]) for s in mine}
                low = sum(weight[s] * min(c, win.count(s)) for s, c in mine.items())
                high = sum(weight[s] * max(c, win.count(s)) for s, c in mine.items()) + rare * sum(s not in mine for s in win)
                if low / high >= at_least:
                    out.add((d, i))
    return out


def test_leaks_equal_all_windows(spark, table, odd_texts):
    items = [" ".join(words(20 + i, ("b", i))) for i in range(8)] + ["A short one", None, "", " ".join(words(20, ("b", 0))) + " and more of it"]
    plain = [" ".join(words(60, ("p", i))) for i in range(6)]
    w = items[5].split()
    texts = odd_texts + [f"{p} {items[i].upper().replace(' ', ', ')}! {p}" for i, p in enumerate(plain)] + plain
    texts += [" ".join(w[:3] + ["changed"] + w[4:]), " ".join(w[1:]), " ".join(w[:8]), items[6], items[6], f"{items[7]} {items[7]}", "a SHORT one"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    df = table(texts)
    got = decontaminate.leaks(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_leaks(texts, items)
    clean = decontaminate.without_leaks(df, bench)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {r["doc_id"] for r in got}
    assert decontaminate.leaks(table([]), bench).count() == 0 and decontaminate.leaks(df, bench.limit(0)).count() == 0


def test_large_benchmarks_are_joined_by_shuffle(spark, table, odd_texts, monkeypatch):
    items = [" ".join(words(18 + i, ("big", i))) for i in range(5)]
    texts = odd_texts + [f"{t} and more" for t in items] + [edited(items[0], 1, 3), items[1] + " " + items[1]] * 2
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = lambda: sorted(map(tuple, decontaminate.leaks(table(texts), bench).collect()))
    sent = rows()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sent and rows() == sent


def test_items_of_few_words_are_found_inside(spark, table):
    bench = spark.createDataFrame([(1, "Rare name"), (2, "one two three four"), (3, "unseen")], "item_id bigint, text string")
    texts = ["it is a rare, NAME of him", "rare other name", "zero one two three four five", "one two three", None, "Rare name rare name"]
    got = sorted((r["doc_id"], r["item_id"], r["start_word"]) for r in decontaminate.leaks(table(texts), bench).collect())
    assert got == [(0, 1, 3), (2, 2, 1), (5, 1, 0), (5, 1, 2)]


def test_equal_items_are_all_reported(spark, table):
    item = " ".join(words(20, "equal"))
    bench = spark.createDataFrame([(i, item) for i in range(40)] + [(40, item.upper())], "item_id bigint, text string")
    got = decontaminate.leaks(table([f"so {item} it is", item]), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(d, i) for d in range(2) for i in range(41)]


def test_windows_near_the_threshold_against_all_windows(spark, table):
    """Every start is tried here, not only those that line up; copies lose words, gain words and swap them."""
    rng, texts = random.Random(8), []
    items = [words(rng.randint(20, 60), ("near", i)) for i in range(12)]
    for k in range(240):
        w = list(items[k % 12])
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [f"new{rng.randrange(99)}"] * rng.randint(0, 1)
        texts.append(" ".join(words(rng.randint(0, 9), k) + w + words(rng.randint(0, 9), -k)))
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    held = {}
    for i in items:
        for s in set(grams(i)):
            held[s] = held.get(s, 0) + 1
    want, rare = set(), np.log1p(12)
    for d, t in enumerate(texts):
        all_ = grams(t.split())
        for i, it in enumerate(items):
            g = grams(it)
            for a in range(-len(g) + 1, len(all_) if set(g) & set(all_) else 0):
                win = all_[max(a, 0) : a + len(g)]
                if len(set(win) & set(g)) < len(g) / 2:
                    continue
                low = sum(np.log1p(12 / held[s]) * min(g.count(s), win.count(s)) for s in set(g))
                high = sum(np.log1p(12 / held[s]) * max(g.count(s), win.count(s)) for s in set(g)) + rare * sum(s not in g for s in win)
                if low / high >= 0.8:
                    want.add((d, i))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(table(texts), bench).collect()}
    assert got <= want and len(want) > 60
    assert len(got) >= 0.99 * len(want)


def test_items_without_an_id_leak_too(spark, table):
    items = [" ".join(words(20, ("null", i))) for i in range(3)]
    bench = spark.createDataFrame([(None, items[0]), (None, items[0]), (None, items[1]), (7, items[2])], "item_id bigint, text string")
    df = table([f"before it {t} and after" for t in items] + ["nothing of it here"])
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench).collect()) == [(0, None), (1, None), (2, 7)]
    assert [r["doc_id"] for r in decontaminate.without_leaks(df, bench).collect()] == [3]


def test_blocks_guarantee_the_radius(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 15)))
        rows.append((simhash.signed(a), simhash.signed(b)))
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    share = F.size(F.array_intersect(decontaminate.blocks(F.col("a"), 15), decontaminate.blocks(F.col("b"), 15)))
    assert df.where(share == 0).count() == 0
    hashes = [simhash.signed(rng.getrandbits(64)) for _ in range(9)]
    bits = spark.createDataFrame([(hashes,)], "h array<bigint>").select(decontaminate.simhash(F.col("h"))).first()[0]
    assert bits == simhash.signed(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 9))


# -- revisits


def test_canonical_addresses(spark):
    urls = {
        "HTTP://WWW.Example.org:80/a/?utm_source=x&b=2&a=1#top": "example.org/a?a=1&b=2",
        "https://example.org/a?a=1&b=2": "example.org/a?a=1&b=2",
        "example.org": "example.org",
        "https://example.org/?ref=z": "example.org",
        "https://example.org:8080/Ab//": "example.org:8080/Ab",
    }
    rows = spark.createDataFrame(list(urls.items()), "url string, want string")
    assert rows.where(revisit.canonical(F.col("url")) != F.col("want")).count() == 0


@pytest.mark.parametrize("slice_rows", [1, 1024])
def test_revisits_equal_a_search(spark, slice_rows):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        kind = rng.choice(["response", "revisit", "revisit", "warcinfo"])
        headers = {"ETag": rng.choice(["e1", "W/e1", "e2"]), "Content-Type": "t", "Vary": str(i)} if rng.random() < 0.7 else {} if rng.random() < 0.8 else None
        rows.append((i, f"http://h/{rng.choice('aaaaabc')}" if i else None, rng.choice([None, *range(60)]), kind, headers, rng.choice([None, "d1", "d2"])))
    df = spark.createDataFrame(rows, "record_id bigint, url string, at bigint, kind string, headers map<string,string>, digest string")
    out = {r["record_id"]: r for r in revisit.resolve(df, slice_rows).collect()}
    assert out.keys() == {r[0] for r in rows if r[3] == "revisit"}
    for i, url, at, kind, headers, digest in rows:
        if kind != "revisit":
            continue
        before = [r for r in rows if r[3] == "response" and r[1] == url and at is not None and r[2] is not None and r[2] < at]
        got, h = out[i], {k.lower(): v for k, v in (headers or {}).items()}
        if not before:
            assert got["status"] == "no_response" and got["response_id"] is None
            continue
        r = max(before, key=lambda r: (r[2], r[0]))
        old = {k.lower(): v for k, v in (r[4] or {}).items()}
        strip = lambda t: t and t.removeprefix("W/")
        pairs = [(strip(h.get("etag")), strip(old.get("etag"))), (digest, r[5])]
        both = [(a, b) for a, b in pairs if a is not None and b is not None]
        status = "unchecked" if not both else "resolved" if both[0][0] == both[0][1] else "changed"
        merged = h if status == "changed" else old | {k: v for k, v in h.items() if k in revisit.PERMITTED}
        assert (got["status"], got["response_id"], got["digest"]) == (status, r[0], r[5])
        assert got["headers"] == "; ".join(f"{k}: {v}" for k, v in sorted(merged.items()))
    assert revisit.resolve(df.limit(0)).count() == 0


# -- pipeline


def test_pipeline_stages_follow_each_other(spark, tmp_path):
    good = [" ".join(words(120, ("g", i))) for i in range(80)]
    junk = [" ".join(f"{w}&&&" for w in words(80, ("j", i))) for i in range(60)]
    item = " ".join(words(40, "item"))
    good += [edited(good[0], 1, 1), f"{good[1][:300]} {item} {good[2][:200]}", "mail me at somebody.12@mail1.example.com " + good[3][::-1]]
    texts = good + junk
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(len(texts))], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, str(tmp_path)).cache()
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and after.keys() <= before.keys()
        if name != "pii":
            assert all(after[i] == before[i] for i in after)
        kept.append(set(after))
    quality, near, clean, last = kept
    assert set(range(80)) <= quality and not quality & set(range(len(good), len(texts)))
    assert quality - near == {80} and near - clean == {81} and last == clean
    assert "somebody" not in after[82]["text"] and "[EMAIL]" in after[82]["text"] and after[82]["n_chars"] == len(after[82]["text"])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == clean
    assert pii.base_spans(after[82]["text"]) == []


def test_stages_on_empty_documents(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
