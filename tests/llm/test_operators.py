"""The operators against brute force on small tables: NULLs, empty and long texts, repeats, empty tables, clashing names."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from rillstone.llm import backoff, imatch, language, licences, neargraph, packing, repeats, simhash, tokens, urls
from rillstone.llm.components import components

RANKS, FILE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = "a passage of some length that several of the documents share word for word, so that it is found to repeat in them. "


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(n))


TEXTS = [
    (1, words(1, 120)), (2, None), (3, ""), (4, words(2, 60) + PASSAGE + words(3, 40)), (5, words(1, 120)),
    (6, PASSAGE + words(4, 30)), (7, "x"), (8, "  \n\t "), (9, "é" * 150 + words(5, 20) + "é" * 150), (10, "ab" * 400),
    (11, words(6, 9000)), (12, "Naïve <|endoftext|> don't  stop\n\n now…"), (None, words(7, 30)), (13, words(8, 50)),
    (13, words(8, 50)), (14, "MiXeD Case " + words(1, 117)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "l", f"s{k % 3}", k, k, k) for k, (i, t) in enumerate(TEXTS)]
    schema = "doc_id long, text string, lang string, block string, id int, kept int, fp int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_bpe_round_trip(docs, none):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    whole = tiktoken.Encoding("w", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    # tiny chunks, so that many texts are stitched, and some overlaps hold no beginning
    out = tokens.encode(docs, RANKS, public_tokenizers.PATTERN, stride=64, overlap=16)
    assert out.columns == [*docs.columns, "ids"]
    rows = out.withColumn("bytes", tokens.decode("ids", RANKS)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert list(r["ids"]) == whole.encode_ordinary(r["text"] or "")
        assert bytes(r["bytes"]) == (r["text"] or "").encode()
    assert tokens.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_simhash_links(spark, docs, none):
    def brute(text):
        found = (text or "").encode().lower().split()
        if not found:
            return 0
        runs = [b" ".join(found[k : k + 4]) for k in range(max(1, len(found) - 3))]
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    got = {(r["doc_id"], r["text_hash"]): r for r in simhash.near_duplicates(docs).collect()}
    prints = [(i, brute(t)) for i, t in TEXTS]
    for i, fp in prints:
        group = {i}
        near = {fp}
        while True:
            more = {f for _, f in prints if any((f ^ x).bit_count() <= 4 for x in near)}
            if more == near:
                break
            near = more
        group = min((j for j, f in prints if f in near and j is not None), default=None)
        mine = [r for r in got.values() if r["doc_id"] == i]
        assert all(r["component_id"] == group and r["fp"] % 2**64 == fp for r in mine)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id in (1, 5, 2, 3, 8)").collect()) == [1, 2]


def test_large_groups_of_variants_are_split(spark):
    base = 0x0123456789ABCDEF
    prints = {base ^ sum(1 << int(b) for b in np.random.default_rng(k).choice(64, 3, replace=False)) for k in range(60)}
    prints |= {base ^ (0xFF << 20), 5, 7}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    plain = {tuple(sorted(r)) for r in components(simhash.links(df, 4)).collect()}
    split = {tuple(sorted(r)) for r in components(simhash.links(df, 4, group=8)).collect()}
    assert plain == split and len(plain) > 40


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3), (50, None)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 130), 100)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_repeats(rows, length):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            piece = data[p : p + length]
            if piece in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(piece)
        spans = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, bytes(b for b, g in zip(data, gone, strict=True) if not g), len(data), sum(gone), spans))
    return sorted(out, key=str)


def test_repeats(docs, none):
    got = repeats.without_repeats(docs, block_bytes=2000)
    rows = [(r["id"], bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got.collect()]
    assert sorted(rows, key=str) == brute_repeats(TEXTS, 100)
    assert repeats.without_repeats(none).count() == 0


def test_repeats_over_many_edits(spark):
    rng = np.random.default_rng(3)
    base = words(9, 300)
    rows = []
    for k in range(40):  # copies with edits in them: dictionary phrases that share a part
        text = list(base)
        for at in rng.integers(0, len(text), 4):
            text[at] = "#"
        rows.append((k, "".join(text)))
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=8000)
    out = [(r["id"], bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got.collect()]
    assert sorted(out, key=str) == brute_repeats(rows, 100)


def test_packing(docs, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(FILE)
    cut = packing.pieces(docs, FILE, capacity=128, ids=True)
    for r in cut.filter("start = 0 and doc_id = 12").collect():
        assert list(r["ids"]) == plain.encode(TEXTS[11][1], add_special_tokens=False).ids + [1]
    out = packing.packed_documents(docs, FILE, capacity=128).toPandas()
    assert out["doc_tokens"].sum() > 0 and (out.groupby("sequence_id")["length"].sum() <= 128).all()
    for _, one in out.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert one["offset"].tolist() == [0, *one["length"].cumsum().tolist()[:-1]]
    total = sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
    assert out["length"].sum() == total
    for r in out[out["doc_id"] == 11].itertuples():
        ids = plain.encode(TEXTS[10][1], add_special_tokens=False).ids + [1]
        assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    assert packing.packed_documents(none, FILE).count() == 0


def test_hot_lengths_are_ranked_in_shares(spark):
    rows = spark.createDataFrame([(k, 0, 7 if k % 3 else 5, k, 7) for k in range(600)],
                                 "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    out = packing.pack(rows, capacity=32, each=50).toPandas()
    assert not out.duplicated(["sequence_id", "offset"]).any() and len(out) == 600
    assert (out.groupby("sequence_id")["length"].sum() <= 32).all()


def test_patterns_hold_every_length():
    histogram = {int(k): int(v) for k, v in zip(*np.unique(np.random.default_rng(0).integers(1, 65, 5000), return_counts=True), strict=True)}
    found = Counter()
    for kind, count in packing.patterns(histogram, 64):
        assert sum(kind) <= 64
        for length in kind:
            found[length] += count
    assert found == histogram


@pytest.mark.parametrize("histogram", [
    {1: 1000}, {300: 1000}, {2048: 3, 7: 293},
    # a third of all pieces has one length
    {n: 100_000 if n == 300 else 200_000 // 2047 for n in range(1, 2049)},
    {n: 100_000 if n == 60 else 200_000 // 2047 for n in range(1, 2049)},
    {n: 100_000 if n == 100 else 200_000 // 600 for n in range(100, 701)},
])
def test_a_hot_length_leaves_little_padding(histogram):
    found, sequences = Counter(), 0
    for kind, count in packing.patterns(histogram, 2048):
        assert sum(kind) <= 2048
        sequences += count
        for length in kind:
            found[length] += count
    assert found == histogram
    fits = max(2048 // max(histogram), 1) * max(histogram) if len(histogram) == 1 else 2048
    assert sequences <= 1.02 * sum(n * c for n, c in histogram.items()) / fits + 1


def test_backoff_automaton(docs, none):
    def read(t):
        return [*(t or "").encode().lower().split(), None]

    learned = F.col("doc_id") % 2 == 0
    train = [read(t) for i, t in TEXTS if i is not None and i % 2 == 0]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([None, *t], t, strict=False))
    n, v, mu = sum(count.values()), len(count), 300.0
    rows = backoff.score(docs, learned, ~learned, block_bytes=3000).collect()
    got = Counter()
    for r in rows:
        got[r["id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)] += 1
        assert r["train_tokens"] == n
    want = Counter()
    for i, t in TEXTS:
        tokens_ = read(t)
        root = [(count[w] + 1) / (n + v + 1) for w in tokens_]
        step = sum(math.log10((pairs[p] + mu * q) / (count[p[0]] + mu))
                   for p, q in zip(zip([None, *tokens_], tokens_, strict=False), root, strict=False))
        want[i, len(tokens_), sum(count[w] > 0 for w in tokens_), round(sum(map(math.log10, root)), 6), round(step, 6)] += 1
    assert got == want
    assert backoff.score(none, learned, ~learned).count() == 0
    # every state's arcs sum to one
    state = 1 + count[None]
    assert state > 1


def test_language_families(spark, none):
    stock = {"en": "the of and to in is that was for with", "de": "der die und das ist nicht ein für mit auch",
             "fr": "le la les des est pas une que dans avec", "es": "el la los que por una para con del como"}
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(rng.choice(stock[x].split(), 30)), x) for k, x in enumerate(list(stock) * 60)]
    rows += [(900, None, "en"), (901, "12 34 !!", "de"), (902, "der und", None), (903, "", None)]
    docs_ = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs_.filter("doc_id % 8 < 4 and doc_id < 900"), sample=50, buckets=1 << 12)
    got = {r["doc_id"]: r for r in language.predict(docs_.drop("lang"), model).collect()}
    assert np.mean([got[i]["lang_pred"] == x for i, _, x in rows if i < 900 and i % 8 > 3]) > 0.95
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 903))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.fit(docs_.limit(0))
    assert {r["lang_pred"] for r in language.predict(docs_, nothing).collect()} == {"und"}
    assert language.predict(none, model).count() == 0


def test_text_in_no_learned_language_is_rejected(spark):
    import corpus_pipeline

    stock = {"en": "the of and to in is that was for with", "de": "der die und das ist nicht ein für mit auch",
             "fr": "le la les des est pas une que dans avec", "es": "el la los que por una para con del como"}
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(rng.choice(stock[x].split(), 30)), x) for k, x in enumerate(list(stock) * 100)]
    short = [(500 + k, x, None) for k, x in enumerate(["the", "der und das", "le la les", "para los que", "that was in the"])]
    other = [(600 + k, x, None) for k, x in enumerate([
        "Szybki brązowy lis przeskakuje nad leniwym psem i biegnie dalej przez las",
        "Nopea ruskea kettu hyppää laiskan koiran yli ja juoksee metsään",
        "Быстрая коричневая лиса прыгает через ленивую собаку", "xqzv kjwq zzxv qpfj wvkx jqzx vkwq xzjq pqvx"])]
    docs_ = spark.createDataFrame(rows + short + other, "doc_id long, text string, lang string")
    left = {r["doc_id"] for r in corpus_pipeline.keep_known_languages(spark, docs_, "").collect()}
    assert left == {i for i, *_ in rows + short}


def test_vector_graph(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(150, 16))
    near = np.repeat(base[:6], 25, axis=0) + rng.normal(size=(150, 16)) * 0.08
    rows = [(k, v.tolist(), int(k % 2)) for k, v in enumerate([*base, *near])]
    rows += [(400, rows[0][1], 0), (401, rows[0][1], 1), (402, None, 0), (403, [0.0] * 16, 0), (404, [1.0, None], 0),
             (405, [float("nan")] * 16, 0), (406, rows[0][1], None), (407, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    settings = neargraph.Settings(shard=40, per_centre=30, threshold=0.93)  # shards are split
    out = neargraph.near_duplicates(df, settings=settings).collect()
    assert len(out) == len(rows)
    usable = [(i, np.array(v), x) for i, v, x in rows if v and len(v) == 16 and np.isfinite(v).all() and any(v) and x is not None]
    true = found = 0
    by_id = {r["vec_id"]: r for r in out}
    for i, v, x in usable:
        n = sum(x == y and w @ v / math.sqrt((w @ w) * (v @ v)) >= 0.93 for _, w, y in usable) - 1
        assert by_id[i]["n_links"] <= n
        true, found = true + n, found + by_id[i]["n_links"]
    assert found >= 0.9 * true and out[0]["recall"] >= 0.9
    assert all(by_id[i]["n_links"] == 0 and by_id[i]["component_id"] == i for i in (402, 403, 404, 405, 406, 407))
    assert by_id[400]["component_id"] == by_id[0]["component_id"] == 0
    assert neargraph.near_duplicates(df.limit(0)).count() == 0


def test_url_rules_and_model(spark):
    rules = [urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/")]
    rows = [("http://a.example.com/en/1",), ("http://www.example.com/en/1",), ("HTTP://X.COM?q=a://b/c",), ("no scheme",),
            (None,), ("",), ("x://notexample.com/en/",), ("https://example.org/a?b=1&c=2#d",), ("https://EXAMPLE.com/en/x#y",)]
    pages = spark.createDataFrame(rows, "url string").withColumn("host", F.lit("clash"))
    got = {r["url"]: r for r in urls.fit(pages, rules, trees=2).judge(pages).collect()}
    assert [(got[u]["host"], got[u]["path"], got[u]["rule"]) for u, in rows] == [
        ("a.example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/1", "www.example.com/en/"), ("x.com", "", None),
        ("", "", None), ("", "", None), ("", "", None), ("notexample.com", "/en/", "com/"), ("example.org", "/a", None),
        ("example.com", "/en/x", "example.com/en/")]
    assert all(r["verdict"] in ("allow", "block") for r in got.values())
    assert got["http://a.example.com/en/1"]["verdict"] == "block"
    empty = pages.limit(0)
    assert urls.fit(empty, rules).judge(empty).count() == 0


def test_imatch(spark, docs, none):
    got = imatch.compare(docs, low=0.0, high=1.0)
    rows = got.collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in order]
    edited = {}
    for k, (i, _) in enumerate(order):
        t, other = texts[k], texts[(k + 1) % len(texts)]
        cut = len(t) // 3
        edited[i] = t[: len(t) - cut] + other[:cut]
    assert len(rows) == len(TEXTS)
    prints = {}
    for r in rows:
        assert r["edited_sha256"] == hashlib.sha256(edited[r["id"]].encode()).hexdigest() or r["id"] in (13, None)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints[r["id"]] = r["fingerprint"]
    assert prints[1] == prints[5] and prints[2] == prints[3] and prints[1] != prints[4]
    assert imatch.compare(none).count() == 0


def test_imatch_keeps_the_whole_band(spark):
    # each word stands in two texts, and there are more of them than 8,192
    texts = [" ".join(f"w{(8 * k + j) % 12_000}" for j in range(16)) for k in range(1500)]
    short = ["v1 v2", "v2 v3", "v3 v1"]
    df = spark.createDataFrame(list(enumerate(texts + short)), "doc_id long, text string")
    band = {r[0] for r in imatch.lexicon(df, "text", 0.0, 0.5).collect()}
    assert band == {np.int64(np.uint64(xxhash.xxh64_intdigest(w, 42))) for w in
                    [f"w{k}" for k in range(12_000)] + ["v1", "v2", "v3"]}
    rows = imatch.compare(df, low=0.0, high=0.5).collect()
    assert len(rows) == len(df.collect()) and all(r["n_chars"] > 0 for r in rows)
    got = {r["id"]: r["fingerprint"] for r in rows}
    assert not any(got[k].startswith("text..") for k in range(1500))
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "a b"), (4, "a b")], "doc_id long, text string")
    assert Counter(r["id"] for r in imatch.compare(twice, low=0.0, high=1.0).collect()) == {None: 3, 4: 1}


def test_licences(spark, none):
    rows = [(1, "some plain words here\nReleased under the MIT License.\nmore"), (2, None), (3, ""), (4, "the license of birds to fly far"),
            (5, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."), (5, "nothing at all"),
            *((100 + k, words(k, 40)) for k in range(60))]
    docs_ = spark.createDataFrame(rows, "doc_id long, text string")
    out = licences.fit(docs_, sample=200).scan(docs_).collect()
    assert len(out) == len(rows)
    got = {(r["id"], r["n_paragraphs"]): list(r["licences"]) for r in out}
    assert got[1, 3] == ["mit"] and got[5, 2] == ["apache-2.0", "mit"] and got[2, 1] == [] and got[4, 1] == [] and got[5, 1] == []
    assert licences.fit(none).scan(none).count() == 0


def test_licences_learn_from_every_paragraph(spark):
    """The model and its mark come from all background, not from a part of it, and copies of a table change neither."""
    rows = [(k, "\n".join([words(k, 3), f"this work and the license of {words(k + 9000, 2)}"])) for k in range(2500)]
    docs_ = spark.createDataFrame([*rows, (9999, "Released under the MIT License.\nx\n\n...")], "doc_id long, text string")
    found = licences.fit(docs_)
    assert found.trained + found.marked == 2 * 2500 + 1
    assert 0.3 < found.marked / (found.trained + found.marked) < 0.37
    seen = found.paragraphs(docs_)
    assert seen.filter("likely <> 'unknown'").count() <= 1 + 0.005 * 5000
    assert [r["family"] for r in seen.filter("family is not null").collect()] == ["mit"]
    again = licences.fit(docs_.unionByName(docs_))
    assert (again.trained, again.marked) == (2 * found.trained, 2 * found.marked)
    assert again.doubt == pytest.approx(found.doubt, abs=1e-3)
