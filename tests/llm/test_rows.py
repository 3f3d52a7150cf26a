"""Operators that read each text alone: token counts, packing, personal data, quality, language."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staylens.llm import boosting, language, packing, pii, quality, token_counts
from staylens.llm.shared import tokenizer_path

PIECES = ["a", "the ", "'s", "'ll", "'re", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "日本", "😀", "12", "!!", "<|endoftext|>", "<|", "don't", "\r\n", "ß", "_", "́", "İ", "Σ", "THE"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=14).map("".join)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(tokenizer_path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def counts():
    return token_counts.PrefixCounts(tokenizer_path(token_counts.VOCABULARY))


@settings(max_examples=300, deadline=None)
@given(text=TEXTS, limit=st.integers(0, 8))
def test_prefix_counts_equal_the_library(byte_library, counts, text, limit):
    n = lambda t: len(byte_library.encode(t, add_special_tokens=False).ids)
    [(total, reach)] = counts.count_all([text], limit)
    assert total == n(text)
    if "<|" not in text:
        fits = [i for i in range(len(text) + 1) if n(text[:i]) <= limit]
        assert max(i for i in range(len(text) + 1) if len(text[:i].encode()) <= reach) == max(fits)


def test_prefix_table_of_a_piece(byte_library, counts):
    table = counts.table(" unbelievably")
    assert [len(byte_library.encode(" unbelievably"[:i]).ids) for i in range(len(table))] == list(table)


def test_caches_may_overflow(byte_library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 3)
    small = token_counts.PrefixCounts(tokenizer_path(token_counts.VOCABULARY))
    texts = ["one two three four five", "six seven one two", "one eight"]
    assert [x[0] for x in small.count_all(texts, 9)] == [len(byte_library.encode(t).ids) for t in texts]


def test_token_counts_of_odd_rows(table, odd_texts, byte_library):
    odd_texts = [*odd_texts, odd_texts[6] * 60]
    out = {r["doc_id"]: r for r in token_counts.token_counts(table(odd_texts)).collect()}
    for i, t in enumerate(odd_texts):
        n = len(byte_library.encode(t or "", add_special_tokens=False).ids)
        assert (out[i]["n_bytes"], out[i]["n_tokens"], out[i]["over_limit"]) == (len((t or "").encode()), n, n > 1024)
    assert token_counts.token_counts(table([])).count() == 0
    assert {r["doc_id"] for r in token_counts.token_counts(table(["a", "b"], [None, 3])).collect()} == {None, 3}


@settings(max_examples=200, deadline=None)
@given(text=TEXTS)
def test_word_ids_equal_the_library(text):
    ids = packing.word_ids(tokenizer_path(packing.VOCABULARY))
    assert ids.of([text]) == [np.array(ids.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


def check_pieces(rows, limit, ids_of):
    docs, bins = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    for key, pieces in docs.items():
        at, ids = 0, ids_of(key)
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) // 4
            assert r["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert at == len(ids) // 4
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limit and at & (at - 1) == 0  # no padding at all
    return docs, bins


def test_packing_keeps_every_id(table, odd_texts):
    odd_texts = [*odd_texts, odd_texts[6] * 60]
    library = packing.word_ids(tokenizer_path(packing.VOCABULARY))
    rows = packing.pack_texts(table(odd_texts)).collect()
    docs, _ = check_pieces(rows, 2048, lambda k: library.of([odd_texts[k] or ""])[0] + b"\1\0\0\0")
    assert len(docs) == len(odd_texts)
    assert packing.pack_texts(table([])).count() == 0
    assert {r["doc_id"] for r in packing.pack_texts(table(["a"], [None])).collect()} == {None}


def test_packing_holds_all_limits_at_once():
    rng = np.random.default_rng(1)
    limits = packing.Limits(tokens=64, segments=4, loss=40, pool=32)
    examples = []
    for i in range(300):
        n = int(rng.integers(1, 60))
        mask = (rng.random(n) < rng.random()).astype(np.int64)
        if mask.sum() <= limits.loss:
            examples.append(packing.Example(i, bytes(4 * n), mask, 0, n))
    for cut in (False, True):
        bins = list(packing.sequences(iter(examples), limits, cut))
        for b in bins:
            assert sum(map(len, b)) <= limits.tokens and len(b) <= limits.segments and sum(e.demand() for e in b) <= limits.loss
        assert sum(len(e) for b in bins for e in b) == sum(map(len, examples))
        if not cut:
            assert sorted(e.key for b in bins for e in b) == sorted(e.key for e in examples)
            fewest = max(-(-sum(map(len, examples)) // 64), -(-sum(e.demand() for e in examples) // 40), -(-len(examples) // 4))
            assert len(bins) <= 1.25 * fewest


def test_whole_examples_over_a_limit_are_kept(spark):
    rows = spark.createDataFrame([(1, [5] * 10, None), (2, [6] * 3, [True, False, True]), (3, None, None)], "doc_id int, ids array<int>, loss array<boolean>")
    out = {r["doc_id"]: r for r in packing.pack_examples(rows, packing.Limits(tokens=8, segments=2, loss=8)).collect()}
    assert out.keys() == {1, 2} and out[1]["length"] == 10 and out[2]["loss_tokens"] == 2


SPANS = ["a@b.c", "+1 (234) 555-1234", "x", "@", "..", "1.2.3.4", "300.1.2.3", "4111 1111 1111 1111", " ", "+", "-", "@@", "é", "44444", "(", "1", "_", "0" * 30 + ".1.1.1"]


@settings(max_examples=500, deadline=None)
@given(text=st.lists(st.sampled_from(SPANS), max_size=9).map("".join))
def test_base_spans_are_the_patterns_matches(text):
    want = [(k, m.start(), m.end()) for k, p in pii.BASE.items() for m in p.finditer(text) if pii.passes(k, m[0])]
    assert pii.base_spans(text) == want


def test_checks_of_the_formats():
    assert pii.passes("card", "4111 1111 1111 1111") and not pii.passes("card", "4111 1111 1111 1112") and not pii.passes("card", "0")
    assert pii.passes("ip", "255.0.000255.1") and not pii.passes("ip", "256.0.0.1") and not pii.passes("ip", "9" * 5000 + ".1.1.1")


def test_personal_data_of_rows(table):
    texts = [f"call +1 ({200 + i}) 555-{1000 + i} or mail m{i}@mail{i}.example.com from 10.0.{i}.7 v{i}.{i} token={i}abc{i * 7919}" for i in range(60)]
    texts += [None, "", "at (234) 555-0199 now", "the 4.0 and 1234567 things"] + texts[:2]
    df = table(texts)
    model = pii.learned(df.select(F.coalesce("text", F.lit("")).alias("text")))
    out = {r["doc_id"]: r for r in pii.find(df, model).collect()}
    for i, t in enumerate(texts):
        base = pii.base_spans(t or "")
        assert out[i]["base_sha256"] == hashlib.sha256(pii.as_text(base).encode()).hexdigest()
        assert out[i]["n_phone"] == sum(s[0] == "phone" for s in base)
        assert set(pii.as_text(base).split(",")) <= set(out[i]["spans"].split(","))
    assert out[63]["spans"] == ""
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    texts_out = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts_out[60] is None and texts_out[61] == "" and texts_out[63] == texts[63]
    assert texts_out[0].startswith("call [PHONE] or mail [EMAIL] from [IP] v0.0")
    assert pii.find(table([])).count() == 0 and pii.redact(table([])).count() == 0


def test_free_forms_are_found_and_decoys_left(table):
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    prose = lambda n: " ".join(word() for _ in range(n))
    fit = table([f"{prose(20)} {i}. {prose(9)} +1 ({200 + i % 700}) 555-{1000 + i} {prose(9)} {word()}.{i}@mail{i % 9}.example.com {prose(20)}" for i in range(600)])
    model = pii.learned(fit.select("text"))
    assert model.thresholds.keys() == pii.LOOSE.keys()
    hidden = {"email_like": "jane.doe (at) example (dot) org", "phone_like": "(234) 555-0199", "number_like": "2345550199"}
    left = ["1987 1988 1989", "12 345 678", "4111111111111112", "they met (at) noon. Then", "1712345678901"]
    texts = [f"{prose(8)} {s} {prose(8)}" for s in [*hidden.values(), *left]]
    found = [[(k, t[a:b]) for k, a, b in model.chosen(t, pii.base_spans(t))] for t in texts]
    for (kind, s), got in zip(hidden.items(), found):
        assert [x for _, x in got] == [s] and (got[0][0] == kind or kind == "phone_like")
    assert found[3:] == [[]] * len(left)


def test_boosted_trees_learn_a_rule_of_two_features():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = boosting.Boosted().fit(x[:1500], y[:1500])
    margin = trees.margin(x[1500:])
    assert ((margin > 0) == y[1500:]).mean() > 0.95  # cuts are quantiles, 32 of them
    a, b = boosting.platt(margin, y[1500:])
    assert a > 0 and abs(boosting.sigmoid(a * margin + b).mean() - y[1500:].mean()) < 0.02


def quality_tables(spark, table):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(200)]
    good = [" ".join(rng.choice(words, 60)) for _ in range(150)]
    bad = [" ".join(f"{w}&&&" for w in rng.choice(words, 60)) for _ in range(75)] + ["spam spam spam " * 20 for _ in range(75)]
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)], "doc_id bigint, quality int, toxic int")
    return table([*good, *bad, None, "", good[0]]), labels


def test_quality_on_documents_it_has_not_seen(spark, table):
    df, labels = quality_tables(spark, table)
    out = {r["doc_id"]: r for r in quality.scores(df, labels).collect()}
    held = [i for i in range(300) if out[i]["held_out"]]
    assert held == [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i]["predicted"] == int(i < 150) for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())
    assert out[300]["score"] == out[301]["score"] and out[302]["score"] == out[0]["score"]
    kept = {r["doc_id"] for r in quality.kept(df, labels).collect()}
    assert kept == {i for i, r in out.items() if r["predicted"]}


def test_quality_without_labels_or_rows(spark, table):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.scores(table(["a b", None]), none).collect()} == {0.5}
    assert quality.kept(table(["a b", None]), none).count() == 2
    assert quality.scores(table([]), none).count() == 0


def test_word_vectors_add_up_over_tasks(spark, table):
    df = table(["one two three four", "two three", "five"])
    parts = {r["slot"]: r["entries"] for r in quality.contexts(df.repartition(3)).collect()}
    at, sign = quality.index_vectors()
    want = {}
    for t in ["one two three four", "two three", "five"]:
        s = quality.slots(t)
        for i, x in enumerate(s):
            for j in range(max(0, i - 2), min(len(s), i + 3)):
                if i != j:
                    v = want.setdefault(int(x), np.zeros(quality.SIZE))
                    v[at[s[j]]] += sign[s[j]]
    assert parts.keys() == {k for k, v in want.items() if v.any()}
    assert all(np.allclose(parts[k], want[k]) for k in parts)


EN, DE = "the and of with this from that were ", "der und die von mit das nicht eine "


def test_language_from_all_evidence(spark):
    docs = spark.createDataFrame([(i, EN * 5, "en") for i in range(9)] + [(i, DE * 5, "de") for i in range(9, 18)] + [(99, None, None)], "doc_id bigint, text string, lang string")
    page = lambda lang, text: f'<html lang="{lang}"><style>p{{}}</style><script>var der="und";</script><p>{text}</p></html>'
    rows = [(i, f"http://a.example.de/{i}", page("de", DE), "en") for i in range(8)] + [(i, f"https://b.example.com/{i}", page("en", EN), "x") for i in range(8, 16)]
    rows += [(16, "http://a.example.de/x", "<p></p>", ""), (17, None, None, None), (18, "http://b.example.com", page("de", DE), ""), (0, "http://a.example.de/0", page("de", DE), "en")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, lang string")
    got = language.identify(pages, docs).collect()
    out = {r["page_id"]: r for r in got}
    assert len(got) == 20 and all(out[i]["lang"] == "de" for i in range(8)) and all(out[i]["lang"] == "en" for i in range(8, 16))
    assert out[16]["lang"] == "de" and out[17]["lang"] is not None and out[18]["lang"] == "de"
    assert all(0 <= r["probability"] <= 1 for r in got)
    assert language.identify(pages.limit(0), docs).count() == 0
    assert {r["lang"] for r in language.identify(pages, docs.limit(0)).collect()} == {None}


def test_declared_language_stands_anywhere():
    tag = '<html class="a" lang="de-DE"><p>x</p>'
    assert language.declared(f"<!-- {'x' * 30_000} -->{tag}") == "de" and language.declared(f"{' ' * 30_000}{tag}") == "de"
    assert language.declared(f'<!-- <html lang="en"> -->{tag}') == "de" and language.declared('<!-- <html lang="en">') is None
    assert language.declared("<html " * 20_000 + ">") is None


def test_language_equals_the_formula(spark):
    docs = spark.createDataFrame([(1, EN * 3, "en"), (2, DE * 3, "de")], "doc_id bigint, text string, lang string")
    rows = [(1, "http://h.x/1", f'<html lang="de">{EN}'), (2, "http://h.x/2", f"<html>{DE}"), (3, "http://g.x/", "<html>zz qq")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    langs, t = language.likelihoods(docs)
    log = {}
    for i, _, html in rows:
        s = language.trigrams(language.visible(html))
        log[i] = t[s].sum(axis=0) * min(1, language.EVIDENCE / len(s))
    own = {i: language.softmax(x) for i, x in log.items()}
    marks = {1: "de", 2: "none", 3: "none"}
    held = {m: sum((own[i] for i in own if marks[i] == m), np.zeros(2)) + 0.5 for m in ("de", "none")}
    total = sum(own.values())
    base = (total + 1) / (total.sum() + 2)
    for r in language.identify(pages, docs).collect():
        i = r["page_id"]
        suffix = np.maximum(total - own[i], 0)
        host = np.maximum(sum(own[j] for j in own if (j < 3) == (i < 3)) - own[i], 0)
        prior = (suffix + 4 * base) / (suffix.sum() + 4)
        prior = (host + 4 * prior) / (host.sum() + 4)
        p = language.softmax(log[i] + np.log(held[marks[i]] / sum(held.values())) + np.log(prior))
        assert r["lang"] == langs[int(p.argmax())] and r["probability"] == pytest.approx(p.max(), rel=1e-9)


def test_letters_are_encoded_once_for_all_marks_and_cases():
    path = tokenizer_path(packing.VOCABULARY)
    ids, asked = packing.WordIds(path), []
    encode, learn_runs = ids.encode, ids.learn_runs
    ids.encode = lambda texts: asked.extend(texts) or encode(texts)
    ids.learn_runs = lambda runs: asked.extend(runs) or learn_runs(runs)
    ids.of(["Zwölfling zwölfling, ZWÖLFLING!! zwölfling... (x"])
    assert sorted(asked) == ["!!", "(x", ",", "...", "zwölfling"]
    odd = ["Dİ!! dİ İ ΟΔΟΣ, οδος. ÿŸ; éa, café! don't, 'tis ab's!! ª² º! ß_ µ- ẞ? a b, İ!" + "q" * 200 + "," + "w" * 120 + "!" * 150 + " " + "!" * 150, "ﬁn, ǅ! ² ½ 12, ３４!"]
    for text in odd:
        assert ids.of([text]) == encode([text])
    assert not any(len(w) > packing.LONGEST or w == "zwölfling," for w in ids.words)


def test_marks_that_end_a_word_are_words_of_their_own():
    ids, asked = packing.WordIds(tokenizer_path(packing.VOCABULARY)), []
    learn = ids.learn
    ids.learn = lambda words: asked.extend(words) or learn(words)
    texts = ["noon, noon. (noon 12, 12. über), it's, x!'s 'd, ΟΣ, οΣ1, ¿a? -- a.b", "aΣ.a, Σ, Σa. é, é, ...", "a, ¡b! \t c,\td"]
    assert ids.of(texts) == ids.encode(texts)
    assert {"noon", ",", ".", "12", "über", "),"} <= set(asked) and not {"noon,", "noon.", "12,", "über),", "a,"} & set(asked)


def test_texts_go_to_python_a_few_mb_at_a_time(spark, tmp_path, monkeypatch):
    """Also where a table's rows would all fit one batch of Spark's 10 000 rows."""
    spark.range(0, 400, 1, 1).selectExpr("id as doc_id", "repeat(concat('noon ', id, ' '), 3000) as text").write.parquet(f"{tmp_path}/d")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = packing.pack_texts(spark.read.parquet(f"{tmp_path}/d"))
    assert rows.select("doc_id").distinct().count() == 400

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    found = [r["n"] for r in spark.read.parquet(f"{tmp_path}/d").mapInArrow(sizes, "n bigint").collect()]
    assert sum(found) > 9_000_000 and max(found) < 4_000_000
