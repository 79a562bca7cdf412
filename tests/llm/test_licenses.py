"""The canonical form of licence texts against a plain version, and standard files however they are wrapped."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from wordgraph.llm import licenses

NOTICE = re.compile(r"^[^\S\n]*[#*/;-]*[^\S\n]*(?:(?:copyright|\(c\)|©)[^\S\n]*(?:\(c\)|©|[0-9]{4}|\[|<|:|copyright|by\b)|©)")
OTHER = re.compile(r"^[^\S\n]*[#*/;-]*[^\S\n]*(?:copyright\b(?![^\S\n]+(?:notice|holder|owner|law|licen[cs]e|and|or|interest|in)s?\b)"
                   r"|\(c\))[^\n]{0,100}$")


def plain(text):
    """The canonical form, line by line."""
    lines = [" " if NOTICE.match(x) else x for x in text.lower().split("\n")]
    out, i = [], 0
    while i < len(lines):
        j = i
        if i == 0 or not lines[i - 1].strip():
            while j < len(lines) and OTHER.match(lines[j]):
                j += 1
        if j > i and (j == len(lines) or not lines[j].strip()):
            i = j
        else:
            out.append(lines[i])
            i += 1
    words = " ".join(re.findall(r"[^\W_]+", re.sub(r"all rights reserved\.?", " ", "\n".join(out))))
    for old, new in licenses.SPELLINGS:
        words = re.sub(rf"\b{old}\b", new, words)
    return words


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("chars", F.lit("clash"))
    return {r["doc_id"]: r for r in licenses.scan(docs, licenses.known_digests(spark)).collect()}


def test_form(spark):
    texts = [t for _, t in licenses.known_texts() if len(t) < 3000][:40]
    texts += ["Copyright (c) 2020 X\nwords here", "title\nCopyright Jane Doe\n\nbody, of it", "title\n\nCopyright Jane Doe\n\nbody",
              "a copyright\ncopyright notice and this\npermission", "(c) You must retain\nthe rest of it", "© them\nbody",
              "/* Copyright: me */\n# (c) 2001\ntext", "a\n\n(c) others", "", "one\n\n\ntwo - three\tfour", "x" * 100_000 + "\ny"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select(
        "i", licenses.canonical(licenses.canonical_lines(F.col("t"))).alias("form")).collect()
    assert {r["i"]: r["form"] for r in rows} == {i: plain(t) for i, t in enumerate(texts)}


def test_both_spellings_of_every_entry_agree(spark):
    pairs = [(old, new) for old, new in licenses.SPELLINGS]
    texts = [f"you may {w} this work" for pair in pairs for w in pair]
    got = scanned(spark, texts)
    for i, (old, new) in enumerate(pairs):
        assert got[2 * i]["digest"] == got[2 * i + 1]["digest"], (old, new)


@pytest.mark.parametrize("width", [60, 72, 80, None])
def test_known_texts_however_wrapped(spark, width):
    known = [(n, t) for n, t in licenses.known_texts()[:60] if len(t) > 200]
    head = "Copyright (c) 2021 Some One\n\n"
    texts = [licenses.rewrapped(t, width) for _, t in known] + [head + licenses.rewrapped(t, width) for _, t in known]
    got = scanned(spark, texts)
    assert [got[i]["license"] for i in range(len(texts))] == [n for n, _ in known] * 2


def test_usual_files(spark):
    isc = ("Copyright (c) 2004-2010 by Some Consortium\nCopyright 1995 Others\n\nPermission to use, copy, modify, and/or distribute this software "
           "for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission "
           "notice appear in all copies.\n\n" + licenses.KNOWN["ISC"][licenses.KNOWN["ISC"].index("THE\nSOFTWARE"):])
    got = scanned(spark, [isc, None, "", "***", "Text.\nReleased under the MIT license\nLicensed under CC BY-NC 4.0", licenses.KNOWN["Unlicense"]])
    assert [got[i]["license"] for i in range(6)] == ["ISC", None, None, None, None, "Unlicense"]
    assert got[4]["notices"] == ["CC-BY-NC-4.0-line", "MIT-line"] and got[1]["digest"] is None
    assert got[0]["digest"] == hashlib.sha256(plain(isc).encode()).hexdigest()


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(docs, licenses.known_digests(spark)).count() == 0
    same = spark.createDataFrame([(1, "a b")] * 3 + [(None, "a b")], "doc_id long, text string")
    assert licenses.scan(same, licenses.known_digests(spark)).groupBy("digest").count().collect()[0]["count"] == 4
