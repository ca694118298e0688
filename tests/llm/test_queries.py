"""The queries on the smallest tables: against SQL where there is some, else against plain Python."""

import hashlib
import os
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash

import public_tokenizers
from ledgerfold.llm import language_id, secret_scan, simhash_dedup
from ledgerfold.llm.oracle import llm_sql
from ledgerfold.llm.queries import CONTROL_TEXT, codec, llm_queries
from tests.compare import compare, duckdb_views
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SF_DIR)


def documents(duck, columns="doc_id, text"):
    return duck.execute(f"SELECT {columns} FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return llm_queries()[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_against_sql(spark, duck, name):
    assert compare(spark, duck, llm_queries()[name], llm_sql()[name], SF_DIR) == ""


def test_mix_meets_its_targets(spark):
    found = llm_queries()["op2_source_mix"](spark, f"{TESTDATA}/sf0.01").toPandas()
    assert (found["taken"] <= 2 * found["size"]).all()
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "source").toPandas()
    by_source = found.merge(docs, on="doc_id").groupby("source").agg({"taken": "sum", "target": "first", "size": "max"})
    assert ((by_source["taken"] - by_source["target"]).abs() <= by_source["size"]).all()
    assert by_source["target"].sum() == pytest.approx(1.5 * found["size"].sum())


def test_license_lines_are_found(spark, duck):
    lines = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under the Apache License, Version 2.0.": "apache",
        "Released under the MIT License.": "mit",
        "All rights reserved.": "reserved",
    }
    expected = {
        (doc_id, number, lines[line])
        for doc_id, text in documents(duck)
        for number, line in enumerate(text.split("\n"))
        if line in lines
    }
    found = {(r.doc_id, r.paragraph, r.family) for r in rows(spark, "op3_license_scan") if r.confirmed}
    assert expected and found == expected


def test_languages_of_held_out_texts(spark, duck):
    known = dict(documents(duck, "doc_id, lang"))
    found = rows(spark, "op5_language_id")
    assert len(found) == len(known)
    asked = [r for r in found if r.held_out]
    right = sum(r.lang_pred == known[r.doc_id] for r in asked)
    assert len(asked) > 20 and right >= 0.95 * len(asked)
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.rejected for r in found) <= 0.01 * len(found)


def test_conversations_read_back(spark, duck):
    turns = duck.execute("SELECT conv_id, turn, role, coalesce(text, '') FROM conversations ORDER BY 1, 2").fetchall()
    turns += [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    expected = {}
    for conv_id, _, role, text in turns:
        expected.setdefault(conv_id, []).append((role, text))

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    found = {r.conv_id: r for r in rows(spark, "op6_chat_format")}
    assert found.keys() == expected.keys()
    for conv_id, said in expected.items():
        learnt = "".join(text for role, text in said if role == "assistant")
        r = found[conv_id]
        assert (r.n_turns, r.turns_sha256) == (len(said), sha("".join(f"{role}\n{text}\n" for role, text in said)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), sha(learnt))
        assert r.formatted_chars >= sum(len(role) + len(text) + 24 for role, text in said)


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(points):
    """Smallest index reachable over distances of at most 3."""
    values = np.array(points, np.uint64)
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def test_near_copies_against_all_pairs(spark, duck):
    docs = documents(duck)
    points = [plain_fingerprint(text or "") for _, text in docs]
    ids = [doc_id for doc_id, _ in docs]
    roots = plain_components(points)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op7_simhash_dedup")}
    assert found == {ids[i]: (f"{points[i]:016x}", ids[roots[i]]) for i in range(len(ids))}
    assert len(set(roots)) < len(ids)


def plain_spans(text):
    found = []
    pattern = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.A) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets_keep_the_base_spans(spark, duck):
    found = {r.doc_id: r for r in rows(spark, "op8_secret_scan")}
    docs = documents(duck)
    assert found.keys() == {doc_id for doc_id, _ in docs}
    hits = 0
    for doc_id, text in docs:
        spans = plain_spans(text or "")
        written = [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans]
        r = found[doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == written
        hits += len(spans)
    assert hits


def test_tokens_are_the_tokenizers(spark, duck):
    ranks = {token: rank for rank, token in enumerate(codec().tokens)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in rows(spark, "op9_byte_bpe")}
    for doc_id, text in documents(duck):
        ids = plain.encode_ordinary(text or "")
        r = found[doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_codec_on_hard_texts():
    mine = codec()
    ranks = {token: rank for rank, token in enumerate(mine.tokens)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["", "\0", "a" * 50_000, " " * 20_000, "ab" * 20_000, "it's\x85\x1c x 　y", "<|endoftext|>"]
    texts += [between.join(points[at : at + 4000]) for between in ("", "a") for at in range(0, len(points), 4000)]
    for text in texts:
        ids = mine.encode(text)
        assert ids == plain.encode_ordinary(text)
        assert mine.decode(ids).decode() == text


def near_points(seed, n, near):
    rng = np.random.default_rng(seed)
    seeds = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    moved = [s ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c)) for s in seeds[:near] for b, c in [rng.integers(0, 64, 2)]]
    return np.unique(np.concatenate([seeds, np.array(moved, np.uint64)]))


@pytest.mark.parametrize("shard, piece", [(150, 10_000), (150, 60), (10_000, 500), (40, 7)])
def test_cells_lose_no_pair(shard, piece):
    points = near_points(5, 3000, 800)
    tree = simhash_dedup.build_tree(points[::3], len(points), shard=shard)
    which, shards, own = simhash_dedup.route(tree, points)
    assert np.array_equal(np.sort(which[own]), np.arange(len(points)))
    homes, queries = simhash_dedup.pieces(tree, points[::3], len(points), piece, piece)
    which, shards, left, right, first = simhash_dedup.deal(tree, homes, queries, points)
    links, sizes = simhash_dedup.Links(len(points)), []
    for cell in sorted(set(zip(shards.tolist(), left.tolist(), right.tolist()))):
        here = (shards == cell[0]) & (left == cell[1]) & (right == cell[2])
        frame = pd.DataFrame({"point": points[which[here]].view(np.int64), "first": first[here]})
        found = simhash_dedup._cell_links(cell, frame)
        a, b = (np.searchsorted(points, found[c].to_numpy(np.int64).view(np.uint64)) for c in "ab")
        links.add(a, b)
        sizes.append(int(here.sum()))
    assert links.root.tolist() == plain_components(points)
    # A cell holds two pieces, which are of about `piece` points; small ones vary more.
    if piece == 10_000:
        assert len(which) == len(simhash_dedup.route(tree, points)[0])
    assert max(sizes) <= 2 * piece + 8 * piece**0.5 + 10


def test_cells_stay_bounded_at_a_million_points():
    rng = np.random.default_rng(9)
    points = rng.integers(0, 1 << 64, 1_000_000, dtype=np.uint64)
    tree = simhash_dedup.build_tree(points[: simhash_dedup.SAMPLE], len(points))
    _, routed, _ = simhash_dedup.route(tree, points)
    assert np.bincount(routed).max() > 200_000  # what one shard would hold
    homes, queries = simhash_dedup.pieces(tree, points[: simhash_dedup.SAMPLE], len(points), query_piece=50_000)
    _, shard, left, right, _ = simhash_dedup.deal(tree, homes, queries, points)
    _, sizes = np.unique(shard * 10_000 + left * 100 + right, return_counts=True)
    assert sizes.max() <= 2.2 * simhash_dedup.SHARD
    assert len(shard) <= 20 * len(points)


def learnable(sf, per_language=400):
    """(lang, text), the first of each language."""
    found, seen = [], Counter()
    for r in pq.read_table(f"{TESTDATA}/{sf}/documents.parquet", columns=["lang", "text"]).to_pylist():
        if r["lang"] and r["text"] and seen[r["lang"]] < per_language:
            seen[r["lang"]] += 1
            found.append((r["lang"], r["text"]))
    return found


def fitted(rows):
    return language_id.fit([language_id.example(lang, text) for lang, text in rows])


def test_language_left_out_is_rejected():
    docs = learnable("sf0.1")
    for left in ("es", "fr", "de"):
        model = fitted([row for row in docs if row[0] != left])
        unlearnt = [model.predict(text)[2] for lang, text in docs if lang == left]
        assert sum(unlearnt) >= 0.9 * len(unlearnt) > 50


def test_texts_kept_apart_from_the_fit_stay():
    docs = learnable("sf0.01")
    for part in range(2):
        model = fitted(docs[part::2])
        apart = [model.predict(text)[2] for _, text in docs[1 - part :: 2] if len(set(text.split())) >= 30]
        assert sum(apart) <= 0.01 * len(apart)


def test_short_passages_of_other_languages_are_rejected():
    model = fitted(learnable("sf0.1"))
    passages = (
        "La donna è mobile qual piuma al vento, muta d'accento e di pensiero.",
        "De kat zit op de mat en kijkt naar de vogels buiten in de tuin.",
        "Suomi on pohjoismainen valtio, joka sijaitsee Euroopassa.",
        "Gallia est omnis divisa in partes tres, quarum unam incolunt Belgae.",
    )
    assert [model.predict(text)[2] for text in passages] == [True] * 4
