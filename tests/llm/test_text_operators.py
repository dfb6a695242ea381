"""Text operators against brute-force versions and on edge rows."""

import hashlib
import math
import itertools
import re
import textwrap
import zlib

import numpy as np
import pytest

from martwise.llm import license_scan, mixing, ngram_jaccard, piece_encoding, quality_classifier, quality_rules, token_records, toxicity
from martwise.llm.common import ship
from martwise.llm.components import connected_components
from martwise.llm.queries import QUERIES, piece_model, word_model
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def edge_docs(spark):
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, "b", 4), (4, "one two three four five six", "en", "b", 27),
            (4, "one two three four five six", "en", "b", 27), (None, "one two three four five six", None, None, None),
            (None, None, None, None, None), (5, "one two three", "en", "a", 13), (5, "one two three", "fr", "a", 13),
            (6, long_text, "en", "a", None), (7, long_text + " tail", "en", "c", None), (8, "İK\x00 apache license\nmit  License cc\nby", "en", "c", 30)]
    return spark.createDataFrame(rows, DOC)


def clash(df):
    """Extra columns named like result columns."""
    for name in ("size", "target", "copies", "score", "kept", "labels", "n_words", "ids", "links", "class_id", "toxic"):
        df = df.withColumn(name, df["doc_id"].cast("string"))
    return df


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


# mixing ------------------------------------------------------------------------------------------

def reshared(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by sharing the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        got = {s: left * weight[s] / sum(weight[t] for t in rest) for s in rest}
        over = [s for s in rest if got[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **got}
        fixed.update({s: cap * sizes[s] for s in over})


def test_targets_equal_resharing(shipped):
    sizes = {"a": 10, "b": 5000, "c": 300, "d": 300, "e": 0, None: 1200, "Z": 40, "é": 77}
    got = mixing.source_targets(shipped.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = reshared(sizes)
    assert {r["source"]: r["target"] for r in got} == pytest.approx(want)


def test_mix_emits_the_planned_copies(shipped):
    docs = documents(shipped)
    plan = {r["doc_id"]: r for r in mixing.plan_mix(docs).collect()}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: r["copies"] for k, r in plan.items() if r["copies"]}
    assert all(int(r["rate"]) <= r["copies"] <= int(r["rate"]) + 1 for r in plan.values())
    assert all(r["size"] == len(WORD.findall(r["text"] or "")) for r in plan.values())
    again = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(docs.repartition(7)).collect()}
    assert again == {k: r["copies"] for k, r in plan.items()}


def test_mix_edges(shipped):
    docs = clash(edge_docs(shipped))
    rows = mixing.plan_mix(docs).collect()
    assert len(rows) == 12 and all(r["size"] == len(WORD.findall(r["text"] or "")) for r in rows)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


# quality rules -----------------------------------------------------------------------------------

def brute_stats(text):
    words = WORD.findall(text or "")
    grams = list(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


@pytest.mark.parametrize("text", [None, "", " ", "a", "a b", "a a a a", "a b c a b c", "x\nx\n\n \nx\ny|", "a b c d a b c " * 9, "é # $ é # $"])
def test_text_stats(text):
    assert quality_rules.text_stats(text) == brute_stats(text)


def test_text_stats_on_documents(shipped):
    docs = [r["text"] for r in documents(shipped).limit(60).collect()]
    for t in docs:
        assert quality_rules.text_stats(t) == brute_stats(t)


def test_bad_host_is_rejected_and_edges(shipped):
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, good, "en", "good", 1) for i in range(40)] + [(100 + i, bad if i < 38 else good, "en", "bad", 1) for i in range(40)]
    rows += [(200, good, "en", None, 1), (201, None, "en", None, 1), (202, good, "en", "new", 1)]
    docs = clash(shipped.createDataFrame(rows, DOC))
    scored = quality_rules.score_documents(docs)
    out = quality_rules.with_verdicts(scored, quality_rules.host_verdicts(scored))
    kept = {r["doc_id"] for r in out.collect() if r["kept"]}
    assert kept == set(range(40)) | {200, 202}
    empty = quality_rules.score_documents(docs.limit(0))
    assert quality_rules.with_verdicts(empty, quality_rules.host_verdicts(empty)).count() == 0


# token records -----------------------------------------------------------------------------------

def test_crc32c_known_values():
    got = token_records.crc32c([b"123456789", b"\0" * 32, b"\xff" * 32, bytes(range(32)) * 40])
    assert [hex(x) for x in got[:3].tolist()] == ["0xe3069283", "0x8a9136aa", "0x62a8ab43"]
    assert got[3] == token_records.crc32c([bytes(range(32)) * 40])[0]


def library_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(word_model())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_word_tokenizer_equals_the_library():
    texts = ["Hello   World's don't I'LL x²³½ 42abc!!!", "Σίσυφος ΟΔΟΣ", "İstanbul ǅ", "áé é", "x\x1cy\x1fz\x85w\xa0v", "日本語 text",
             "<|endoftext|> a", "", None, "Å ﬁ ﷺ", "naïve café ÀÉ ß ẞ", "a_b__c -- 's 't''s", "  line sep"]
    tok = token_records.WordTokenizer(word_model())
    assert [np.frombuffer(x, np.uint16).tolist() for x in tok.encode(texts)] == library_ids(texts)
    tok.LIMIT = 3  # forgetting what is known changes nothing
    for _ in range(3):
        assert [np.frombuffer(x, np.uint16).tolist() for x in tok.encode(texts)] == library_ids(texts)


def test_word_tokenizer_forgets_and_stays_right():
    tok = token_records.WordTokenizer(word_model())
    tok.LIMIT = 150
    texts = [" ".join(f"word{(i * 7 + k) % 400}$$" for k in range(9)) for i in range(300)]
    got = [np.frombuffer(x, np.uint16).tolist() for x in tok.encode(texts)]
    assert got == library_ids(texts) and len(tok.words) <= 600


def test_records_round_trip(shipped):
    docs = documents(shipped)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    manifest = token_records.write_records(docs, word_model())
    got = sorted(token_records.read_records(manifest).collect())
    start = 0
    for (doc_id, _), ids, r in zip(rows, library_ids([t for _, t in rows]), got, strict=True):
        ids = ids + [1]
        raw = np.array(ids, "<u4").tobytes()
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) == (doc_id, start, len(ids), zlib.crc32(raw), ids)
        start += len(ids)


def test_records_edges_and_damage(shipped):
    docs = clash(edge_docs(shipped))
    manifest = token_records.write_records(docs, word_model())
    got = token_records.read_records(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, 1, 2, 3, 4, 4, 5, 5, 6, 7, 8]
    assert [r["start"] for r in got] == [0, *itertools.accumulate(r["n_tokens"] for r in got)][:-1]
    assert {r["doc_id"]: r["ids"] for r in got}[1] == [1]
    none = token_records.write_records(docs.limit(0), word_model())
    assert token_records.read_records(none).count() == 0
    shard = manifest.collect()[0]
    path = shard["records"].removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[20] ^= 1
    bad = path + ".bad"
    open(bad, "wb").write(bytes(data))
    index = np.frombuffer(open(shard["index"].removeprefix("file:"), "rb").read(), np.uint64).reshape(-1, 2)
    with pytest.raises(ValueError, match="damaged"):
        list(token_records.frames(bad, index))
    frames = list(token_records.frames(path, index[::-1]))  # any order
    assert len(frames) == len(index)


# n-gram Jaccard ----------------------------------------------------------------------------------

def brute_links(texts):
    sets = []
    for t in texts:
        w = WORD.findall(t or "")
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    links = [set() for _ in texts]
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    pairs = {p for h in holders.values() for p in itertools.combinations(h, 2)}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
            links[i].add(j)
            links[j].add(i)
    return links


def classes(links):
    top = list(range(len(links)))
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(links):
            low = min([top[i], *(top[j] for j in near)])
            if low != top[i]:
                top[i], changed = low, True
    return top


def check_jaccard(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = brute_links([t for _, t in rows])
    top = classes(links)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_jaccard.near_duplicates(docs).collect()}
    assert got == {d: (rows[top[i]][0], len(links[i])) for i, (d, _) in enumerate(rows)}
    stay = {r["doc_id"] for r in ngram_jaccard.keep_one(docs).collect()}
    assert stay == {rows[t][0] for t in top}


def near_copies(n, words=90, seed=1):
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.integers(0, 5)):
            w[rng.integers(0, words)] = f"e{rng.integers(0, 10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_jaccard_on_documents(shipped):
    check_jaccard(shipped, sorted((r["doc_id"], r["text"]) for r in documents(shipped).collect()))


def test_jaccard_in_blocks(shipped, monkeypatch):
    texts = near_copies(150) + near_copies(40, 33, 2) * 2 + ["", None, " ", "a b", "a b", "a b c"]
    rows = list(enumerate(texts))
    check_jaccard(shipped, rows)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 32)  # blocks are dealt out on the driver
    check_jaccard(shipped, rows)


def test_jaccard_edges(shipped):
    docs = clash(edge_docs(shipped))
    out = ngram_jaccard.near_duplicates(docs)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["class_id"], r["n_links"]) for r in out.collect() if r["class_id"] is not None)
    assert (False, 0, 4, 2) in got and got.count((True, 4, 4, 2)) == 2 and got.count((True, 5, 5, 1)) == 2
    assert (True, 6, 6, 1) in got and (True, 7, 6, 1) in got and (True, 1, 1, 0) in got
    one = ngram_jaccard.keep_one(docs)
    assert one.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in one.collect()) == [0, 1, 2, 3, 4, 5, 6, 8]
    assert ngram_jaccard.near_duplicates(docs.limit(0)).count() == 0 and ngram_jaccard.keep_one(docs.limit(0)).count() == 0


def test_least_matches_keep_what_may_reach_the_threshold():
    from math import comb
    for n, m in ngram_jaccard.least_matches(0.8, 1e-6).items():
        tail = [sum(comb(n + 1, k) * 0.8 ** k * 0.2 ** (n + 1 - k) for k in range(x + 1)) for x in (m - 1, m)]
        assert (tail[0] if m else 0) < 1e-6 <= tail[1]


def test_components_of_a_chain_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# classifiers -------------------------------------------------------------------------------------

def held_out_id(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_quality_held_out_accuracy(shipped):
    sf = SF001.replace("sf0.001", "sf0.01")
    got = {r["doc_id"]: r for r in QUERIES["op7_quality_classifier"](shipped, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in shipped.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == held_out_id(k) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for k, r in got.items())
    test = [k for k in labels if held_out_id(k)]
    assert np.mean([got[k]["predicted"] == labels[k] for k in test]) > 0.95


def test_toxicity_held_out(shipped):
    sf = SF001.replace("sf0.001", "sf0.01")
    got = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](shipped, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in shipped.read.parquet(f"{sf}/labels.parquet").collect()}
    test = [k for k in labels if held_out_id(k)]
    assert np.mean([got[k]["toxic"] == labels[k] for k in test]) > 0.9
    assert all(0 <= r["severity"] <= 3 for r in got.values())
    assert np.mean([got[k]["severity"] for k in test if labels[k]]) > np.mean([got[k]["severity"] for k in test if not labels[k]]) + 0.3


def test_ordinal_fit_orders_the_grades():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 600)
    words = [np.unique(np.append(rng.integers(100, 400, 20), np.arange(1, 1 + 3 * g))) for g in grade]
    theta, ids, w, _ = toxicity.fit(grade, words, np.arange(1, 10))
    assert np.all(np.diff(theta) > 0) and (w >= 0).all()
    total = np.array([w[np.isin(ids, x)].sum() for x in words])
    severity = toxicity._sigmoid(total[:, None] - theta).sum(1)
    means = [severity[grade == g].mean() for g in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1.5


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(4, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None), (5, 3, 3)]])
def test_classifiers_edges(shipped, labels):
    docs = clash(edge_docs(shipped))
    known = shipped.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality_classifier.score(docs, quality_classifier.train(docs, known, bits=12), bits=12).collect()
    assert len(scored) == 12 and all(0 <= r["score"] <= 1 for r in scored)
    graded = toxicity.severity(docs, toxicity.train(docs, known)).collect()
    assert len(graded) == 12 and all(0 <= r["severity"] <= 3 for r in graded)
    assert quality_classifier.score(docs.limit(0), (0.0, np.empty(0, np.int32), np.empty(0, np.float32))).count() == 0
    none = docs.limit(0)
    assert toxicity.severity(none, toxicity.train(none, known)).count() == 0


def test_labels_that_contradict_or_are_held_out_are_not_learnt(shipped):
    out = [k for k in range(50) if held_out_id(k)][0]
    inside = [k for k in range(50) if not held_out_id(k)][:2]
    docs = shipped.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string")
    known = shipped.createDataFrame([(out, 1), (inside[0], 0), (inside[0], 1), (inside[1], 1)], "doc_id long, quality int")
    assert [r["doc_id"] for r in quality_classifier.labelled_texts(docs, known, "quality").collect()] == [inside[1]]


# pieces ------------------------------------------------------------------------------------------

TEXTS = ["", " ", "Hello  world ", "日本語 テキスト", "é́ ﬁ ½ ＡＢＣ", "tab\tnew\nline", "🙂 x", "a　b\xa0c", "ǅ Å K ① ㌀", "​zero﻿", "x" * 50]


def test_pieces_equal_the_library_and_tile_the_source():
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    c = piece_encoding.PieceCodec(piece_model())
    for t in TEXTS:
        e = c.encode(t)
        assert e.ids == library.encode(t) and c.decode(e.ids) == library.decode(e.ids)
        raw = t.encode()
        assert b"".join(raw[a:b] for a, b in zip(e.begin, e.end)) == raw
    assert c.encode(None).ids == []


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normaliser_equals_the_library(rule, prefix, squeeze):
    import sentencepiece
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True,
                                                    remove_extra_whitespaces=squeeze)
    own = piece_encoding.Normaliser(library.serialized_model_proto())
    for t in TEXTS:
        text, source = own(t.encode())
        assert text.decode() == library.normalize(t), (rule, t)
        assert len(source) == len(text) + 1 and (np.diff(source) >= 0).all()


def test_piece_query_outputs_and_edges(shipped):
    docs = clash(edge_docs(shipped))
    out = piece_encoding.encode(docs, piece_model(), tuple(piece_encoding.OUTPUTS)).collect()
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for r in out:
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == library.decode(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert piece_encoding.encode(docs.limit(0), piece_model()).count() == 0


# licenses ----------------------------------------------------------------------------------------

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_scan(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = LICENSE_WORD.findall(low)
    spots = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(words))
             if words[i:i + len(p.split())] == p.split()]
    base = sorted({label for _, label in spots})
    best, found = 1.0 if spots else 0.0, set(base)
    notices = [(label, t.split()) for label, ts in license_scan.NOTICES.items() for t in ts]
    for label, said in notices:
        need = set(said)
        enough = license_scan.THRESHOLD * len(need) - 1e-9
        rivals = [set(other) for name, other in notices if name != label and len(set(other) & need) >= enough]
        telling = {w for w in need if any(w not in r for r in rivals)}
        run = math.ceil(len(said) / license_scan.THRESHOLD - 1e-9) + license_scan.INSERTED
        for i in range(max(len(words) - run, 0) + 1):
            held = set(words[i:i + run])
            if len(held & need) >= enough and telling <= held:
                found.add(label)
                best = max(best, len(held & need) / len(need))
    return (len(words), len(spots), min((i for i, _ in spots), default=None), max((i for i, _ in spots), default=None),
            ",".join(base), ",".join(sorted(found)), best)


def scanned(df):
    return [(r["text"], (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]))
            for r in df.collect()]


def test_scan_equals_brute_force(shipped):
    texts = ["cc by cc by cc by", "Apache License\n\n apache-license.MIT LICENSE", "GNU  General\nPublic License", "macc by", "acc by cc byx cc by",
             "mitK license mit license", "Licensed under CC BY-NC 4.0.", "under licensed cc by 4 0 and nc of the", "cc\x00by", "é cc by é", "İ mit license",
             "released under the mit", "\nReleased under the MIT License.\n", "this work is licensed under the gnu general public license version"]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    docs = shipped.createDataFrame(rows, DOC).unionByName(edge_docs(shipped)).unionByName(documents(shipped))
    for text, got in scanned(license_scan.scan(docs)):
        assert got == brute_scan(text), text


def wrap(text, width, margin=""):
    return "\n".join(margin + line for line in textwrap.wrap(text, width, break_long_words=False))


def test_notices_over_line_breaks_are_found(shipped):
    cases = [(label, t) for label, ts in license_scan.NOTICES.items() for t in ts]
    other = "some words of prose stand before and after all that is looked for here "
    texts = [wrap(other * lead + t + " " + other * 9, width, margin) for _, t in cases
             for lead, width, margin in ((0, 70, ""), (7, 40, " * "), (12, 1, "# "))]
    docs = shipped.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs, keep=["doc_id"]).collect()}
    for i, text in enumerate(texts):
        assert cases[i // 3][0] in got[i]["labels"].split(",") and got[i]["score"] == 1.0, text


def test_words_of_a_notice_far_apart_on_many_lines_are_no_notice(shipped):
    words = license_scan.NOTICES["mit-notice"][1].split()
    texts = ["\n".join(f"{w} prose" for w in words), "\n".join(words), "\n".join(words[2:-1]), "\n".join(words[3:-2])]
    docs = shipped.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(docs, keep=["doc_id"]).collect()}
    assert got[0] == ("", 0.0) and got[1] == ("mit-notice", 1.0)
    for i in (2, 3):
        share = len(set(texts[i].split())) / len(set(words))
        assert got[i] == (("mit-notice", share) if share >= 0.9 else ("", 0.0))


def test_scan_edges(shipped):
    docs = clash(edge_docs(shipped))
    out = license_scan.scan(docs)
    assert out.count() == 12 and set(docs.columns) <= set(out.columns)
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_native_queries_have_no_python(shipped):
    for name in ("op1_mixing", "op10_license_scan"):
        plan = QUERIES[name](shipped, SF001)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
