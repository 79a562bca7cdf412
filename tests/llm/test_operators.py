"""The training-data operators against brute-force versions, and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordgraph.llm import (blocks, bpe, components, langid, licenses, minhash, order, packing, pitman_yor, quality, sharding,
                           simhash, urls)
from wordgraph.llm.tokens import load, public_tokenizer_path
from wordgraph.session import TableCuts

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizer_path()
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six"), (5, "one two three four five six"),
    (5, "one two three four five six"), (6, "Ünïcode\u0085 wörds\x1c don't <|endoftext|> É"), (7, "x" * 5000),
    (None, "a text whose id is null, and long enough"), (8, "$$$ ### ***"), (9, "a b a b a b a b"), (10, "word " * 3000),
]
#: Symbols and marks beyond ASCII, which are no letters, before ASCII marks.
BEYOND = ["hello”.", "say “hello”, world…! Hello.", "hi😀! there", "foo—, bar", "a™. é. É, e\u0301.", "नमस्ते, दुनिया। मेरी, है.",
          "İ. straße! don't. a.b,c x²) a\u00a0. naïve’s;"]


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest documents and odd rows, with an extra column whose name clashes with an inner one."""
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr(
        "doc_id + 1000000 as doc_id", "text", "cast(null as string) as lang")
    return given.union(odd).withColumn("key", F.lit("extra")).withColumn("n_words", F.lit(-1)).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where(F.lit(False))


def split(text):
    return (text or "").encode().split()


# 1 packing

def test_pack_sizes_is_sum_of_squares():
    sizes = np.random.default_rng(3).integers(1, 33, 300)
    where, offset, fills = packing.pack_sizes(sizes, 32)
    count, open_fill = collections.Counter(), {}
    for item, size in enumerate(sizes):
        def change(h):
            after = count.copy()
            if h:
                after[h] -= 1
            if h + size < 32:
                after[h + size] += 1
            return sum(x * x for x in after.values())
        levels = [0] + [h for h in count if count[h] > 0 and h + size <= 32]
        assert change(int(offset[item])) == min(map(change, levels))
        h = int(offset[item])
        assert open_fill.get(where[item], 0) == h
        count[h] -= 1 if h else 0
        if h + size < 32:
            count[h + size] += 1
        open_fill[where[item]] = h + size
    assert [open_fill[i] for i in range(len(fills))] == fills.tolist()


def test_packing(spark, docs, rows):
    got = packing.pack_documents(docs, TOKENIZER).toPandas()
    tokenizer = load(TOKENIZER)
    want = collections.Counter()
    for key, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), 2048):
            want[(key, start, zlib.crc32(ids[start:start + 2048].tobytes()), len(ids))] += 1
    keys = [None if np.isnan(k) else int(k) for k in got.doc_id]
    assert collections.Counter(zip(keys, got.start, got.ids_crc32, got.doc_tokens)) == want
    got = got.sort_values(["sequence_id", "offset"])
    by = got.groupby("sequence_id").length
    assert (got.offset == by.cumsum() - got.length).all() and (by.sum() <= 2048).all()
    assert got.length.sum() / (2048 * by.ngroups) > 0.9


def test_packing_beyond_ascii(spark):
    given = spark.createDataFrame(list(enumerate(BEYOND)), "doc_id long, text string")
    tokenizer = load(TOKENIZER)
    want = {}
    for key, text in enumerate(BEYOND):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        want[key] = (len(ids), zlib.crc32(ids.tobytes()))
    got = packing.pack_documents(given, TOKENIZER).collect()
    assert {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in got} == want


def test_packing_empty(empty):
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


# 2 licences

def test_license_digests(spark):
    text = licenses.KNOWN["MIT"]
    changed = "MIT\n".replace("MIT\n", "") + "Copyright (c) 2020 Someone, all rights reserved\n" + text.upper().replace(
        "SUBLICENSE", "sublicence").replace(",", " ;") + "\n\n(c) others"
    data = [(1, text), (2, changed), (3, text + " and more"), (4, None), (5, ""), (6, "...\n--"),
            (7, "Some words.\nReleased under the MIT license\nmore"), (1, text)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = sorted((r["doc_id"], r["license"], tuple(r["notices"]), r["digest"] is None)
                 for r in licenses.scan(docs, licenses.known_digests(spark)).collect())
    assert got == [(1, "MIT", (), False), (1, "MIT", (), False), (2, "MIT", (), False), (3, None, (), False),
                   (4, None, (), True), (5, None, (), True), (6, None, (), True), (7, None, ("MIT-line",), False)]


def test_standard_license_files(spark):
    mit = "MIT License\n\nCopyright (c) 2024 Jane Doe\n\n" + licenses.KNOWN["MIT"]
    isc = "ISC License\n\nCopyright 2019, Some One\n\n" + licenses.KNOWN["ISC"]
    held = {f.stem: f.read_text("utf-8") for f in licenses.TEXTS.glob("*.txt")}
    bsd = ("BSD 3-Clause License\n\nCopyright (c) 2020, Them\nAll rights reserved.\n\n"
           + dict(licenses.known_texts()[::-1])["BSD-3-Clause"].partition("\n")[2])
    apache = held["Apache-2.0"].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Some Firm")
    data = [("MIT", mit), ("ISC", isc), ("BSD-3-Clause", bsd), ("Apache-2.0", apache), *held.items()]
    data.append(("Apache-2.0", held["Apache-2.0"].split("   APPENDIX")[0]))
    docs = spark.createDataFrame(list(enumerate(t for _, t in data)), "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(docs, licenses.known_digests(spark)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(data)}
    assert {"BSD-2-Clause", "MPL-2.0", "GPL-2.0", "GPL-3.0", "CC-BY-SA-4.0"} <= set(held)


# 3 quality

def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)


def test_quality_base(docs, rows):
    refs = quality.references(docs)
    out = quality.quality(docs, refs).collect()
    got = collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                               r["n_repeat_words"], r["base_failed"]) for r in out)
    assert got == collections.Counter((k, *base(t)) for k, t in rows)
    assert not any(r["kept"] and r["base_failed"] for r in out)


def jsd(p, q):
    bins = set(p) | set(q)
    half = lambda a, b: sum(a.get(i, 0) * np.log2(2 * a.get(i, 0) / (a.get(i, 0) + b.get(i, 0)))
                            for i in bins if a.get(i, 0) > 0) / 2
    return half(p, q) + half(q, p)


def test_quality_divergence(docs, rows):
    refs = quality.references(docs)
    assert {r.lang for r in refs} <= {"en", "de", "fr", "es"}
    out = {r["doc_id"]: r for r in quality.quality(docs, refs).collect()}
    for key, text in rows[:60]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        if len(words) < 100:
            continue
        vocabulary = [({**r.words, "": 1 - sum(r.words.values())}, r) for r in refs]
        want = []
        for q, r in vocabulary:
            p = {w: words.count(w) / len(words) for w in r.words}
            p[""] = 1 - sum(p.values())
            want.append(jsd(p, q))
        assert out[key]["word_divergence"] == pytest.approx(min(want), abs=1e-9)


def test_quality_junk_goes_clean_stays(spark, docs):
    refs = quality.references(docs)
    clean = docs.where("lang is not null").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id")
    out = quality.quality(clean, refs)
    assert out.where("not kept and not base_failed").count() == 0
    junk = quality.quality(clean.withColumn("text", F.regexp_replace("text", " ", r"\$\$\$ ### | ")), refs)
    assert junk.where("kept").count() == 0


def test_quality_letters_without_common_words_go(spark, docs):
    refs = quality.references(docs)
    clean = docs.where("lang is not null").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id")
    shuffled = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "qwzkxjvbfgyhmpcduotlrnseia")
    out = quality.quality(clean.withColumn("text", shuffled), refs).where("n_words >= 100")
    assert out.count() > 10 and out.where("kept").count() == 0
    assert out.where("class_divergence < 0.02").count() > 10


def test_quality_digits_and_blanks_are_no_letters(spark, docs):
    refs = quality.references(docs)
    assert all(r.class_limit >= quality.Limits.least_class_limit for r in refs)
    clean = docs.where("lang is not null").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id")
    for text in (F.translate("text", "aeionrst", "12345678"), F.regexp_replace("text", " ", "          ")):
        out = quality.quality(clean.withColumn("text", text), refs).where("not base_failed").collect()
        assert len(out) > 10 and not any(r["kept"] for r in out)
        # The class test alone tells.
        assert min(r["class_divergence"] for r in out) > max(r.class_limit for r in refs)


def test_quality_keeps_rare_languages(spark, docs):
    rng = np.random.default_rng(5)
    word = lambda: "".join(chr(1072 + int(x)) for x in rng.integers(0, 32, rng.integers(2, 9)))
    texts = [" ".join(word() for _ in range(120)) for _ in range(8)]
    rare = spark.createDataFrame([(-1 - i, t, "ru" if i < 6 else "uk") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string")
    given = docs.select("doc_id", "text", "lang").unionByName(rare)
    # A share of under a hundredth.
    given = given.unionByName(docs.where("lang is not null").select("doc_id", "text", "lang").crossJoin(spark.range(4)).drop("id"))
    refs = quality.references(given)
    assert "ru" in {r.lang for r in refs} and "uk" not in {r.lang for r in refs}
    out = {r["doc_id"]: r for r in quality.quality(rare, refs).collect()}
    assert all(r["kept"] == (not r["base_failed"]) for r in out.values()) and not out[-7]["base_failed"]


def test_language_sample_has_all_labels(spark):
    rows = spark.createDataFrame([(i, f"text {i} of a label", f"l{i}") for i in range(80)], "key long, text string, lang string")
    assert len({lang for lang, _ in langid.sample(rows)}) == 80


# 4 URLs

def test_urls(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]
    data = [(1, None), (2, "no scheme"), (3, "http://Example.COM/en/x"), (4, "http://www.example.com/en/?q"),
            (5, "https://a.net/es/1#x"), (6, "https://a.net/es"), (7, "http://notexample.com/en/x"), (8, "http://b.com"),
            (9, "http://x.org/com/"), (3, "http://Example.COM/en/x"), (10, "ftp://é.net/es/ü://y"), (11, "")]
    pages = spark.createDataFrame(data, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = urls.judge_urls(pages, urls.rule_table(spark, rules)).collect()

    def want(url):
        if url is None or "://" not in url:
            return "", "", None, "allow"
        rest = url[url.index("://") + 3:]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.encode().lower().decode()
        fits = [(len(r), r, v) for v, r in rules for h, p in [r.split("/", 1)]
                if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        best = max(fits, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    assert sorted((r["page_id"], r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in got) == sorted(
        (k, *(x or "" for x in want(u))) for k, u in data)


def test_rules_are_kept_under_their_rarest_token(spark):
    places = spark.createDataFrame([("a.com", "/x/"), ("b.com", "/y/"), ("c.com", "/y/")], "host string, path string")
    index = urls.rule_index(urls.rule_table(spark, [("block", "com/x/"), ("block", "com/y"), ("block", "/")]), places)
    assert {(r["rule"], r["token"]) for r in index.collect()} == {("com/x/", "x"), ("com/y", "com"), ("/", "")}


# 5 language

def test_language(docs, empty):
    train = docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    model = langid.train(langid.sample(train.selectExpr("doc_id as key", "text", "lang")))
    out = langid.predict(docs, model).join(docs.where("lang is not null").select("doc_id", "lang"), "doc_id")
    right = out.where("lang = lang_pred").count() / out.count()
    assert right > 0.97
    odd = langid.predict(docs.where("doc_id > 1000000 or doc_id is null"), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} == {1000001, 1000002, 1000003, 1000008}
    assert langid.predict(empty, model).count() == 0 and langid.sample(empty.withColumn("key", F.col("doc_id"))) == []
    assert langid.identified(docs, None).where("lang_pred != 'und'").count() == 0


# 6 language model

def test_pitman_yor(docs, rows, empty):
    out = pitman_yor.score_documents(docs).toPandas()
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1
    tokens = [(k, held(k), [w.lower() for w in split(t)] + [b"\n"]) for k, t in rows]
    count = collections.Counter(w for _, h, ws in tokens if not h for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((h, len(ws), sum(w in count for w in ws),
                   round(sum(np.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)) for _, h, ws in tokens)
    got = sorted(zip(out.held_out, out.n_tokens, out.n_known, out.base_score.round(4)))
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])
    assert (out.train_tokens == n).all()
    test = out[out.held_out]
    assert test.score.sum() > test.base_score.sum()
    assert pitman_yor.score_documents(empty).count() == 0


def test_pitman_yor_adds_up_to_one(spark, docs):
    cuts = TableCuts(spark, "test-py")
    given = docs.select(F.col("doc_id").alias("key"), F.lit(False).alias("flag"), "text")
    table = cuts.cut(pitman_yor.blocks(given, fold=True, end=True), "blocks")
    model = pitman_yor.fit(table, cuts)
    words = model.words.collect()
    for context in range(min(4, len(model.contexts))):
        total = 0.0
        for s, back in enumerate(model.back[:, context]):
            root = sum((r["roots"][s] + model.base[s]) / model.guests[s] for r in words) + model.base[s] / model.guests[s]
            assert root == pytest.approx(1.0)
            total += back * root
        gains = sum(g for r in words for c, g in zip(r["contexts"], r["gain"]) if c == context)
        assert (total + gains) / len(model.back) == pytest.approx(1.0)


def test_pitman_yor_rare_contexts_have_restaurants(spark):
    """A rare word's own successor is likelier after it than after another rare word."""
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 1]
    train = [i for i in range(1000) if i not in held][:80]
    filler = " ".join(f"common{i % 8}" for i in range(400))
    texts = [(k, f"{filler} left{i % 40} right{i % 40}") for i, k in enumerate(train)]
    asked = [(held[0], "left7 right7"), (held[1], "left7 right8")]
    out = pitman_yor.score_documents(spark.createDataFrame(texts + asked, "doc_id long, text string"))
    score = {r["doc_id"]: r["score"] for r in out.where("held_out").collect()}
    assert score[held[0]] > score[held[1]] + 0.5


# 7 BPE

def test_bpe(docs, rows, empty):
    tokenizer = load(TOKENIZER)
    want = collections.Counter()
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want[(key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
              hashlib.sha256(decoded.encode()).hexdigest())] += 1
    got = bpe.round_trip(docs, TOKENIZER).collect()
    assert collections.Counter(map(tuple, got)) == want
    assert bpe.round_trip(empty, TOKENIZER).count() == 0


def test_bpe_beyond_ascii(spark):
    given = spark.createDataFrame(list(enumerate(BEYOND)), "doc_id long, text string")
    tokenizer = load(TOKENIZER)
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(given, TOKENIZER).collect()}
    assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(BEYOND)}
    digests = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in bpe.round_trip(given, TOKENIZER).collect()}
    assert digests == {i: (len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()) for i, x in got.items()}


def test_each_distinct_word_is_encoded_once(spark, tmp_path, monkeypatch):
    """Words of several blocks: bundles give every word's ids back in order, and no word is encoded twice."""
    given = [(b, w) for b in range(4) for w in (f"w{b}", "shared", "also", f"x{b % 2}")]
    log = str(tmp_path)
    plain = bpe.encode_words

    def logged(tokenizer, words):
        import uuid

        with open(f"{log}/{uuid.uuid4().hex}", "wb") as out:
            out.write(b"\n".join(words))
        return plain(tokenizer, words)

    bundles = spark.createDataFrame(
        [(b, x["part"], x["words"]) for b in range(4)
         for x in blocks.word_bundles([w.encode() for k, w in given if k == b], 3)], "block long, part int, words binary")
    monkeypatch.setattr(bpe, "encode_words", logged)
    got = bpe.word_ids(bundles, TOKENIZER).join(bundles, ["block", "part"]).collect()
    monkeypatch.undo()
    tokenizer, seen = load(TOKENIZER), collections.Counter()
    for r in got:
        words = zlib.decompress(bytes(r["words"])).split(b"\n")
        lengths, ids = bpe.unpack_numbers(bytes(r["lengths"])), bpe.unpack_numbers(bytes(r["ids"]))
        want = [tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in words]
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want
        seen.update((r["block"], w.decode()) for w in words)
    assert seen == collections.Counter(given)
    encoded = collections.Counter(w for f in tmp_path.iterdir() for w in f.read_bytes().split(b"\n") if w)
    assert encoded == collections.Counter({w.encode() for _, w in given})


# 8 sharding

def test_feistel(spark, docs, empty):
    keys = [F.col("doc_id").asc(), F.crc32("text").asc()]
    out = sharding.shard_rows(docs, keys, 7, seed=5).cache()
    n = docs.count()
    assert sorted(r["position"] for r in out.select("position").collect()) == list(range(n))
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
    for r in out.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect():
        assert r["s"] == list(range(len(r["s"])))
    back = sharding.row_at(out.select("shard", "slot", F.col("row_no").alias("was")), n, 7, seed=5)
    assert back.where("row_no != was").count() == 0
    again = sharding.shard_rows(docs.repartition(5), keys, 7, seed=5)
    assert {(r["row_no"], r["position"]) for r in again.collect()} == {(r["row_no"], r["position"]) for r in out.collect()}
    assert sharding.shard_rows(empty, keys, 7).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 101])
def test_feistel_small(spark, n):
    out = sharding.permuted(spark.range(n), n, 3, "id", "p", steps=2)
    assert sorted(r["p"] for r in out.collect()) == list(range(n))


def test_numbers_of_repeated_rows(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(i,) for i in range(200)], "a long")
    out, n = order.numbered(df, [F.col("a").asc()], TableCuts(spark, "test-order"))
    rows = sorted((r["row_no"], r["a"]) for r in out.collect())
    assert n == 700 and [r[0] for r in rows] == list(range(700)) and [r[1] for r in rows] == sorted(r[1] for r in rows)


# 9 near-duplicates

def brute_components(rows):
    sets = {}
    for i, (key, text) in enumerate(rows):
        w = [x.lower() for x in split(text)]
        sets[i] = frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    lead = list(range(len(rows)))

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for a in sets:
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                lead[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return collections.Counter(
        (key, len(sets[i]), least.get(find(i)), key == least.get(find(i))) for i, (key, _) in enumerate(rows))


def near_rows():
    rng, out = np.random.default_rng(2), []
    words = [f"w{i}" for i in range(500)]
    for group in range(3):
        text = list(rng.choice(words, 120))
        for copy in range(30):
            changed = list(text)
            for at in rng.integers(0, 120, rng.integers(0, 9)):
                changed[at] = str(rng.choice(words))
            out.append(" ".join(changed))
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates(spark, docs, rows, block):
    data = rows + [(k + 2_000_000, t) for k, t in near_rows()]
    given = spark.createDataFrame(data, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = minhash.near_duplicates(given, params=minhash.Params(block=block)).collect()
    assert collections.Counter(map(tuple, got)) == brute_components(data)


def test_near_duplicates_empty(empty):
    assert minhash.near_duplicates(empty).count() == 0


def test_strays_meet_a_large_component_in_linear_rows(spark):
    """20,000 near copies and 10 strays in one bucket: every pair that can matter meets once, rows stay linear."""
    p = minhash.Params()
    given = spark.range(20_010).selectExpr("0 as i", "7L as band", "id as node", "if(id < 20000, 0L, id) as component")
    rows = minhash._cells(given, p).toPandas()
    cells = -(-20_000 // p.block)
    assert len(rows) == 20_000 + 10 * (cells + 1)
    met = collections.Counter()
    for _, group in rows.groupby(["lo", "hi"]):
        strays = group.node[group.component > 0].tolist()
        if group.lo.iloc[0] != group.hi.iloc[0]:
            met.update((s, n) for s in strays for n in group.node[group.component == 0])
        else:
            met.update((a, b) for a in strays for b in strays if a < b)
    assert len(met) == 10 * 20_000 + 45 and set(met.values()) == {1}


def test_groups_over_several_batches():
    import pyarrow as pa

    data = [(0, 5, 0, 0, n) for n in range(7)] + [(0, 6, 0, 1, n) for n in range(3)] + [(1, 6, 0, 1, 1)]
    table = pa.table({c: [r[k] for r in data] for k, c in enumerate([*minhash._GROUP, "node"])})
    for size in (1, 2, 4, 100):
        got = list(minhash._whole_groups(table.to_batches(max_chunksize=size)))
        assert pa.concat_tables(got).to_pylist() == table.to_pylist()
        groups = [set(zip(*(t.column(c).to_pylist() for c in minhash._GROUP))) for t in got]
        assert sum(map(len, groups)) == len(set.union(*groups)) == 3


def test_pruning_keeps_similar_pairs():
    p = minhash.Params()
    needed = minhash.agreements_needed(p)
    rng = np.random.default_rng(0)
    left = rng.integers(0, 2**32, (20_000, p.hashes), dtype=np.uint64).astype(np.uint32)
    same = lambda s: np.where(rng.random(left.shape) < s, left, left + np.uint32(1))
    assert len(minhash.may_link(left, same(0.78), needed)) == len(left)
    assert len(minhash.may_link(left, same(0.4), needed)) < 20


def test_pruning_at_the_threshold():
    """The computed chance that some batch prunes a pair at exactly 0.75."""
    p = minhash.Params()
    alive, done, lost = np.ones(1), 0, 0.0
    for k, least in minhash.agreements_needed(p):
        for _ in range(k - done):
            alive = np.append(alive * 0.25, 0) + np.append(0, alive * 0.75)
        done = k
        lost += alive[:least].sum()
        alive[:least] = 0
    assert lost < 2e-6


def test_components(spark):
    path = [0, *range(63, 0, -1)]
    edges = list(zip(path, path[1:])) + [(100, 101), (102, 101), (103, 103)] + [(200, i) for i in range(201, 260)]
    cuts = TableCuts(spark, "test-components")
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(edges, "u long, v long"), cuts).collect()}
    want = {i: 0 for i in range(64)} | {100: 100, 101: 100, 102: 100} | {200 + i: 200 for i in range(60)}
    assert got == want


# 10 fingerprints

def test_fingerprints(docs, rows, empty):
    cache = simhash.WordHash()
    of = lambda t: simhash.fingerprint(t.encode().lower().split(), cache)
    unique = [(k, t or "") for k, t in dict(rows).items()]
    ordered = sorted(unique, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {r["doc_id"]: r for r in simhash.edited_fingerprints(docs.dropDuplicates(["doc_id"]), parts=5).collect()}
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        edited = simhash.edited_text(text, after)
        r = got[key]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{of(text):016x}", f"{of(edited):016x}")
        assert r["near_next"] == simhash.likeness(of(text), of(after))
    assert simhash.edited_fingerprints(docs, parts=3).count() == len(rows)
    assert simhash.edited_fingerprints(empty).count() == 0


@pytest.mark.parametrize("radius,blocks", [(0, 1), (3, 5), (6, 8)])
def test_radius(spark, radius, blocks):
    rng = np.random.default_rng(radius)
    base_prints = rng.integers(-2**63, 2**63, 60)
    near = [int(x) ^ (1 << int(a)) ^ (1 << int(b)) for x in base_prints for a, b in rng.integers(0, 63, (4, 2))]
    prints = sorted({*map(int, base_prints), *near})
    df = spark.createDataFrame([(x,) for x in prints], "found long")
    got = simhash.within_radius(df.where("found % 3 = 0").withColumnRenamed("found", "query"), df, radius, blocks)
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    asked = [r["query"] for r in df.where("found % 3 = 0").withColumnRenamed("found", "query").collect()]
    want = collections.Counter((q, x, bits(q, x)) for q in asked for x in prints if bits(q, x) <= radius)
    assert collections.Counter(map(tuple, got.collect())) == want


def test_word_ids_of_odd_texts_in_bulk(monkeypatch):
    """Ids are the tokenizer's, and letters of Latin-1 are not encoded word by word."""
    import random

    import pyarrow as pa

    from wordgraph.llm import tokens

    path = tokens.public_tokenizer_path()
    assert tokens.word_parts("\u00c9t\u00e9!?a".encode()) == ["\u00e9t\u00e9".encode(), b"!?a"]
    tokenizer, draw = tokens.load(path), random.Random(3)
    chars = "aBz\u00c0\u00e9\u00df\u00f7\u00d7\u00ff\u0100\u0130\u017f\u0338\u0301.,;'\u2019<|>/w1\u00b2\u00aa\x00\x1c\u00a0\u3000\x85 \n\t\v\f\r"
    texts = ["", None, " ", "ab.<|endoftext|> <|ENDOFTEXT|>x don't \u00e9's J\u030c</w> </w>"]
    texts += ["".join(draw.choice(chars) for _ in range(draw.randint(1, 40))) for _ in range(2000)]
    held = tokens.WordIds(path, limit=3000)  # less than there are: all words are let go of on the way
    for k in range(0, len(texts), 200):
        for text, ids in zip(texts[k:k + 200], held.texts(pa.array(texts[k:k + 200], pa.string()))):
            assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    encoded, plain = [], tokens.encode_words
    monkeypatch.setattr(tokens, "encode_words", lambda t, words: encoded.extend(words) or plain(t, words))
    words = [f"{a}\u00e9{b}" for a in "abcdefghij" for b in "abcdefghij"]
    assert len(list(tokens.WordIds(path).texts(pa.array([" ".join(words)])))) == 1
    assert len(encoded) == 1
