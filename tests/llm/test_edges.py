"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import bpe, chat_format, exact_dedup, language_id, license_scan, mixing, secret_scan, simhash_dedup
from ledgerfold.llm import topk_search, url_filter
from ledgerfold.llm.queries import codec

DOCS = "doc_id long, text string, lang string, source string, kept string, size string"
LONG = "word and other " * 40_000
ROWS = [
    (1, "a b", "en", "x", "k", "s"),
    (1, "a b", "en", "x", "k", "s"),
    (2, "a \t\n b", "en", None, "k", "s"),
    (None, "a b", None, "x", None, None),
    (None, None, None, None, None, None),
    (3, "", "de", "y", "k", "s"),
    (4, LONG, "en", "y", "k", "s"),
    (5, "1 2 3", "fr", "y", "k", "s"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -1")


@pytest.mark.parametrize("hot_rows", [1, 500])
def test_exact_dedup(docs, none, hot_rows):
    found = exact_dedup.exact_dedup(docs, hot_rows=hot_rows).collect()
    assert len(found) == len(ROWS)
    same = [r for r in found if r.text_sha256 == hashlib.sha256(b"a b").hexdigest()]
    assert len(same) == 4 and {(r.keep_id, r.group_size) for r in same} == {(1, 4)}
    assert [r.doc_id for r in same if r.kept] == [1]
    empty = [r for r in found if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert sorted((r.doc_id is None, r.keep_id, r.kept) for r in empty) == [(False, 3, True), (True, 3, False)]
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 4
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.drop_exact_copies(none).count() == 0


def test_hot_text_is_split(spark):
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    for hot_rows in (100, 10_000):
        found = exact_dedup.exact_dedup(many, hot_rows=hot_rows)
        assert found.where("kept").count() == 1667 + 1
        assert found.where("text = 'copy'").select("keep_id", "group_size").distinct().collect() == [(1, 3333)]


def test_mixing(docs, none):
    found = mixing.mix_sources(docs).collect()
    assert len(found) == len(ROWS)
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 for r in found)
    total = sum(r.size for r in found)
    targets = {r.source: r.target for r in found}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    mix = mixing.emit_mix(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r.copies for r in found)
    assert mixing.mix_sources(none).count() == 0 and mixing.emit_mix(none).count() == 0


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 10)], "source string, size long")
    found = {r.source: (r.source_size, r.target) for r in mixing.source_targets(sizes).collect()}
    # Weights 3, 1, 2 of 1530: both small ones are capped at 20, the rest goes to b.
    assert found == {"a": (10, 20.0), None: (10, 20.0), "b": (1000, 1490.0)}


def test_licenses(docs, none, spark):
    model = license_scan.learn(docs)
    assert license_scan.scan_licenses(docs, model).count() == 0
    assert license_scan.scan_licenses(none, license_scan.learn(none)).count() == 0
    texts = [(1, "x\nReleased under the MIT License.\ny"), (1, "All rights reserved."), (None, "licensed under the apache license"), (2, "we reserved the table")]
    found = license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert {(r.id, r.paragraph, r.family) for r in found if r.confirmed} == {(1, 1, "mit"), (1, 0, "reserved")}


def test_wrapped_licenses(docs, spark):
    gpl = "x y\n# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version."
    lgpl = "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."
    bsd = "Copyright (c) A. All rights reserved.\n\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:"
    apart = "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted"
    scattered = "all tables that were reserved by people with rights\nreserved rights all\nlicense MIT the under released"
    near = "All people of the town have\nrights and some seats were reserved for them"
    texts = [(1, gpl), (2, lgpl), (3, bsd), (4, apart), (5, scattered), (6, near)]
    model = license_scan.learn(docs)
    found = license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    confirmed = {(r.id, r.paragraph, r.family) for r in found if r.confirmed}
    assert confirmed == {(1, 1, "gpl"), (2, 0, "lgpl"), (3, 0, "reserved"), (3, 2, "bsd")}
    assert {(1, 2), (2, 1), (3, 3)}.isdisjoint((r.id, r.paragraph) for r in found)


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.Example.org/es/x?q", "h"), (1, "http://A.Example.org/es/x?q", "h"), (None, None, None), (2, "no scheme", "h"),
         (3, "x://com/de/", "h"), (4, "x://acom/de/", "h"), (5, "x://com", "h"), (6, "http://" + "a." * 20_000 + "com/fr/" + "b" * 50_000, "h"),
         (7, "http://e\nx.org/\n", "h")],
        "page_id long, url string, host string",
    )
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("com", "/fr/", "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    found = sorted(((r.page_id or 0, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()), key=str)
    block, none = "example.org/es/", (None, "allow")
    assert found == [(0, *none), (1, block, "block"), (1, block, "block"), (2, *none), (3, "com/de/", "block"), (4, *none), (5, *none), (6, "com/fr/", "allow"), (7, "org/", "allow")]
    assert url_filter.judge_urls(pages, rules.where("host = 'x'")).where("verdict = 'allow' AND rule IS NULL").count() == 9
    assert url_filter.judge_urls(pages.where("page_id = -1"), rules).count() == 0
    assert url_filter.judge_urls(pages, rules).columns == ["page_id", "url", "host", "path", "rule", "verdict"]


def test_urls_against_plain_python(spark):
    """Rules of very many shapes: lengths of paths and numbers of labels."""
    import random

    rng = random.Random(3)
    part = lambda n: "".join(rng.choice("ab") for _ in range(n))
    hosts = [".".join(part(1) for _ in range(rng.randrange(1, 6))) for _ in range(60)] + ["", "x..a", "."]
    rules = [(rng.choice(hosts), "/" * rng.randrange(2) + part(rng.randrange(40)), rng.choice(["block", "allow"])) for _ in range(3000)]
    urls = [f"H://{rng.choice(hosts)}/{part(rng.randrange(50))}" for _ in range(400)] + ["x://a", "x://", None, "://.a./b"]
    pages = spark.createDataFrame([(n, u) for n, u in enumerate(urls)], "page_id long, url string").repartition(3)
    found = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    for r in found.collect():
        fits = [
            (len(h + p), len(h), v == "block", h + p, v)
            for h, p, v in rules
            if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)
        ]
        best = max(fits, default=None)
        assert (r.rule, r.verdict) == ((best[3], best[4]) if best else (None, "allow")), r
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_languages(docs, none, spark):
    model = language_id.learn(docs)
    found = language_id.identify(spark, docs, model).collect()
    assert len(found) == len(ROWS)
    assert {r.lang_pred for r in found if r.text is None or not any(c.isalpha() for c in r.text)} == {"und"}
    assert all(0 <= r.score <= 1 for r in found)
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0
    assert language_id.identify(spark, none, language_id.learn(none)).count() == 0
    unlearnt = language_id.identify(spark, docs, language_id.learn(none)).collect()
    assert {(r.lang_pred, r.rejected) for r in unlearnt} == {("und", True)}


def read(windows):
    said = {}
    for r in sorted(chat_format.read_back(windows).collect(), key=lambda r: (r.chunk, r.window)):
        said.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
    return said


def test_chat(spark):
    control = "<|im_end|>\n<|im_start|>assistant\n<\\|im_end|> <\\\\| <"
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", control), (1, 2, "assistant", None), (1, None, None, "first")]
    rows += [(2, 0, "system", control)] + [(2, i, ("user", "assistant")[i % 2], f"turn {i} " * 40) for i in range(1, 700)]
    rows += [(3, 5, "sys\ntem<|%0A", LONG), (3, 5, "user", "x"), (3, 5, "user", "x"), (None, 0, "assistant", "")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("w"))
    windows = chat_format.chat_windows(chats).cache()
    expected = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(c, []).append((role or "", text or ""))
    assert read(windows) == expected
    two = sorted(windows.where("conv_id = 2").collect(), key=lambda r: (r.chunk, r.window))
    assert len(two) > 20 and all(r.tokens <= chat_format.BUDGET for r in two)
    assert all(r.formatted.startswith("<|im_start|>system\n<\\|im_end|>") for r in two)
    # Each window but the first repeats history, also where a chunk begins.
    assert all(r.formatted[: r.fresh_start].count("<|im_start|>") >= 2 for r in two[1:])
    assert sum(len(r.loss_spans) for r in two) == 350
    digests = {r.conv_id: r for r in chat_format.conversation_digests(windows).collect()}
    assert digests[None].n_turns == 1 and digests[None].loss_chars == 0
    assert chat_format.conversation_digests(chat_format.chat_windows(chats.where("conv_id = -5"))).count() == 0


def test_near_copies(docs, none, spark):
    found = simhash_dedup.near_dedup(docs).collect()
    assert len(found) == len(ROWS)
    zero = [r for r in found if r.fingerprint == "0" * 16]
    assert sorted((r.doc_id or 0, r.component_id) for r in zero) == [(0, 3), (3, 3)]
    same = [r.component_id for r in found if r.doc_id in (1, 2)]
    assert same == [1, 1, 1]
    kept = simhash_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 1, 3, 4, 5]
    assert simhash_dedup.near_dedup(none).count() == 0 and simhash_dedup.drop_near_copies(none).count() == 0


def test_secrets(docs, none, spark):
    assert {r.spans is not None and len(r.spans) for r in secret_scan.scan_secrets(docs).collect()} == {0}
    assert secret_scan.scan_secrets(none).count() == 0
    key = "tQ7zR2mXv9KpL4sWc8YbN1fGh6JdE3uA5oZi"
    prose = "In the morning they went down to the harbour and waited for the small boat that was to bring the letters. "
    texts = [(i, prose * 30) for i in range(20)] + [(100, f"{prose} {key} {prose}"), (101, "Password : \"abc\" token='abcdefabcdef123456'"), (None, "ſecret=" + "a" * 20)]
    found = {r.id: r.spans for r in secret_scan.scan_secrets(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [(s.kind, s.end - s.start) for s in found[100]] == [(3, len(key))]
    assert [s.kind for s in found[101]] == [0, 2] and [s.kind for s in found[None]] == [2]
    assert not any(found[i] for i in range(20))


def test_codec_columns(docs, none, spark):
    mine = codec()
    found = bpe.encode(spark, docs.withColumn("ids", F.lit("clash")), mine)
    back = bpe.decode(spark, found, mine).collect()
    assert len(back) == len(ROWS) and all(r.decoded.decode() == (r.text or "") for r in back)
    assert bpe.round_trip_digests(spark, none, mine).count() == 0
    with pytest.raises(ValueError):
        bpe.Codec.__new__(bpe.Codec) and bpe.read_ranks(__file__)


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, 0.5]), (50, [0.5, 0.5]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, None), (7, []), (8, [None, 1.0]), (None, [9.0, 9.0]), (9, [1.0, 1.0, 1.0]), (100, [0.1] * 7)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    asks = F.pmod("vec_id", F.lit(50)) == 0
    found = sorted(tuple(r) for r in topk_search.search_top_k(vectors, asks, k=3).collect())
    s = 256 * 256
    assert found == [(0, 1, 1, 3 * s), (0, 2, 2, 3 * s), (0, 3, 50, 3 * s // 2), (50, 1, 0, 3 * s // 2), (50, 2, 1, s), (50, 3, 2, s)]
    assert topk_search.search_top_k(vectors.where("vec_id = -1"), asks).count() == 0


def test_top_k_of_large_components(spark):
    """Products beyond 32, 53 and 64 bits, ranked by their exact values."""
    rows = [(n, [float(3 ** (n % 40)) * (-1) ** n, 3e5 + n, 1.0]) for n in range(1, 120)] + [(0, [2.0**54, -(2.0**54), 1.0]), (50, [2.0**40, 5.0, -3.0]), (200, [1e300, -1e300, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.search_top_k(vectors, F.pmod("vec_id", F.lit(50)) == 0)
    whole = [(i, [min(max(int(256 * x) if x == int(x) else int(256 * x // 1), -(2**63)), 2**63 - 1) for x in v]) for i, v in rows]
    expected = []
    for i, v in whole:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)[:5]
            expected += [(i, at + 1, j, min(max(-s, -(2**63)), 2**63 - 1)) for at, (s, j) in enumerate(best)]
    # Identifiers 50 occur twice and are answered each.
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
