"""The pipeline's near-duplicate stage links by SimHash and by exact similarity."""

import corpus_pipeline
from staylens.llm import nearness, simhash
from tests.llm.test_corpus import brute_components, edited, runs, words


def test_near_dedup_stage_keeps_one_of_texts_with_near_fingerprints(spark, table):
    refrain = "alpha beta gamma " * 200
    plain = [" ".join(words(200, i)) for i in range(4)]
    texts = [refrain + " ".join(words(30, k)) for k in ("x", "y")] + plain + [edited(plain[0], 3, 1), edited(edited(plain[0], 3, 1), 3, 2), None, "", plain[1], "a  B", "a b"]
    bits, sets = [simhash.fingerprint(t or "") for t in texts], [runs((t or "").lower()) for t in texts]
    linked = lambda i, j: (bits[i] ^ bits[j]).bit_count() <= 3
    alike = lambda i, j: sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert linked(0, 1) and not alike(0, 1) and any(alike(i, j) and not linked(i, j) for i in range(13) for j in range(i))
    want = brute_components(list(range(len(texts))), lambda i, j: linked(i, j) or alike(i, j))
    df = table(texts)
    out = {r["doc_id"]: r["class_name"] for r in simhash.joint_classes(df).collect()}
    first = {}
    assert [first.setdefault(out[i], i) for i in range(len(texts))] == want
    kept = corpus_pipeline.near_dedup_stage(spark, df, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))
    assert nearness.classes(df).select("class_name").distinct().count() > len(set(want))
