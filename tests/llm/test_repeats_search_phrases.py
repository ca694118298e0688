"""Substring dedup, ranked search and collocations: plain Python on hard rows, and defined results of the edges."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerfold.llm import collocations, lexical_search, substring_dedup
from tests.llm.test_edges import DOCS, LONG, ROWS


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -1")


# --- substring dedup ------------------------------------------------------------------------------------------


def plain_kept(rows, window):
    """The words that stay of every row of (doc_id, text)."""
    texts = [(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc_id, text in rows]
    first = {}
    for doc_id, words in texts:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            first[key] = min(first.get(key, math.inf), math.inf if doc_id is None else doc_id)
    kept = []
    for doc_id, words in texts:
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < (math.inf if doc_id is None else doc_id):
                gone.update(range(at, at + window))
        kept.append((doc_id, text_of(words, gone), len(words), len(gone)))
    return sorted(map(str, kept))


def text_of(words, gone):
    return " ".join(word for at, word in enumerate(words) if at not in gone)


def passages(seed, rows, vocabulary=400):
    """Rows of random words that share, repeat and overlap passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    shared = [[word() for _ in range(rng.randrange(40, 160))] for _ in range(6)]
    found = []
    for n in range(rows):
        words = [word() for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(shared)
            start = rng.randrange(len(passage))
            words += passage[start : start + rng.randrange(1, 120)] + [word() for _ in range(rng.randrange(40))]
        found.append((rng.choice([n, n, n, n // 2, None]), (" " if n % 2 else "\n\t").join(words)))
    found += rng.sample(found, 10)
    return found + [(rows + 1, "a " * 300), (rows + 2, "a " * 200), (rows + 3, "x y " * 120), (rows + 4, "y x " * 60), (None, None), (2, "")]


@pytest.mark.parametrize("seed, block", [(1, 10_000), (2, 3), (3, 0)])
def test_repeats_against_plain_python(spark, seed, block):
    rows = passages(seed, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = substring_dedup.cut_repeats(docs, block_fragments=block)
    assert sorted(str((r.doc_id, r.kept, r.n_words, r.n_removed)) for r in found.collect()) == plain_kept(rows, 50)
    assert found.where("n_removed > 0").count() > 20


def test_repeats_in_short_windows(spark):
    rows = passages(4, 60, vocabulary=3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.cut_repeats(docs, window=9, gram=3, block_fragments=20)
    assert sorted(str((r.doc_id, r.kept, r.n_words, r.n_removed)) for r in found.collect()) == plain_kept(rows, 9)


def test_factor_ends_are_checked():
    first, second = [f"a{i}" for i in range(80)], [f"b{i}" for i in range(80)]
    # The last document goes over from one reference to the other; a third one holds the seam.
    seam = first[40:80] + second[:40]
    mine = first[10:80] + second[:70]
    block = [(1, 11, first), (2, 12, second), (3, 13, seam), (4, 14, mine)]
    found = {owner: spans for owner, _, spans in substring_dedup.parse_block(((o, w, " ".join(t).encode()) for o, w, t in block), 50)}
    gone = {at for a, b in zip(found[4][::2], found[4][1::2]) for at in range(a, b)}
    assert gone == set(range(140)) and found.keys() == {4}
    assert [0, 70] == found[4][:2]


def test_repeats_run_over_piece_ends(spark, monkeypatch):
    rows = passages(5, 40)
    expected = plain_kept(rows, 50)
    cut = {substring_dedup.cut(text.encode(), None, 50, 8)[0] for _, text in rows if text}
    assert max(cut) > 100
    whole = b" ".join(f"w{i % 97}".encode() for i in range(3000))
    runs = list(substring_dedup.word_runs(whole, 50))
    assert [w for first, words in runs for w in words] == whole.split() and expected
    from ledgerfold.llm import texts

    monkeypatch.setattr(texts.pieces, "__defaults__", (500,))
    runs = list(substring_dedup.word_runs(whole, 50))
    assert len(runs) > 5
    for first, words in runs:
        assert words == whole.split()[first : first + len(words)]
    windows = [first + at for first, words in runs for at in range(len(words) - 49)]
    assert windows == list(range(2951))


def test_repeats_of_edges(docs, none):
    found = substring_dedup.cut_repeats(docs)
    assert found.columns == ["doc_id", "text", "lang", "source", "size", "n_words", "n_removed", "kept"]
    rows = found.collect()
    assert len(rows) == len(ROWS) and all(r.n_removed == 0 for r in rows)
    assert {r.n_words for r in rows if r.doc_id == 4} == {len(LONG.split())}
    assert substring_dedup.cut_repeats(none).count() == 0


# --- ranked search --------------------------------------------------------------------------------------------


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counted = [(doc_id, counts) for doc_id, counts in counted if counts]
    rows, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, counts in counted for term in counts)
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, counts in counted:
            m = 100 - 90 + (90 * counts.total() * rows) // length
            asked = [t for t in set(plain_terms(text)) if t in counts]
            score = sum(
                math.floor(1000 * math.log((2 * rows + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in asked
            )
            scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        best = [s for s in sorted(scores, key=lambda s: s[:3]) if s[0] < 0][:k]
        found += [(item_id, rank + 1, s[3], -s[0]) for rank, s in enumerate(best)]
    return sorted(map(str, found))


@pytest.mark.parametrize("shard, block_terms", [(20_000, 500_000), (7, 20)])
def test_search_against_plain_python(spark, monkeypatch, shard, block_terms):
    rng = random.Random(shard)
    words = [f"t{int(rng.paretovariate(0.7))}" for _ in range(3000)] + ["É", "É", "naïve", "A1"]
    text = lambda n: ", ".join(rng.choice(words) for _ in range(n))
    docs = [(rng.choice([i, i, i // 3, None]), text(rng.randrange(80))) for i in range(150)]
    docs += [(7, None), (None, None), (8, ""), (9, "¿?.. --")] + docs[:30] * 2
    items = [(i, text(rng.randrange(30))) for i in range(12)] + [(1, "t1 T1 t2"), (1, "t1 T1 t2"), (None, "t3"), (4, None), (5, "zzz")]
    monkeypatch.setattr(lexical_search, "SHARD_ROWS", shard)
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = lexical_search.search_ranked(given, asked, block_terms=block_terms).collect()
    assert sorted(str((r.item_id, r["rank"], r.doc_id, r.score)) for r in found) == plain_search(docs, items, 10)


def test_accumulators_stop():
    """A frequent term makes no accumulators once ten documents are out of its reach."""
    import numpy as np
    import pyarrow as pa

    rows = 1000
    terms = [[0, 1] if i < 20 else [1] for i in range(rows)]
    table = pa.table({"id": list(range(rows)), "n": [2] * rows, "terms": pa.array(terms, pa.list_(pa.int32())), "tfs": pa.array([[1] * len(t) for t in terms], pa.list_(pa.int64()))})
    shard = lexical_search.Shard(table, rows, 2 * rows)
    found, _ = shard.best(np.array([0, 1]), np.array([6000, 5]), 10, 0)
    assert found.tolist() == list(range(10)) and np.count_nonzero(shard.sums) == 20


def test_search_of_edges(docs, none, spark):
    items = spark.createDataFrame([(1, "word"), (2, "")], "item_id long, text string")
    found = lexical_search.search_ranked(docs, items).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in found] == [(1, 1, 4)]
    assert lexical_search.search_ranked(none, items).count() == 0
    assert lexical_search.search_ranked(docs, items.where("item_id = 9")).count() == 0


# --- collocations ---------------------------------------------------------------------------------------------


def plain_phrases(rows, least, best):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                counts[lang].update(tuple(words[at : at + size]) for at in range(len(words) - size + 1))
    found = []
    for lang, known in counts.items():
        frequent = {p: a for p, a in known.items() if a >= least and len(p) > 1}
        scored = []
        for p, a in frequent.items():
            longer = [q for q, b in frequent.items() if len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if longer:
                continue
            score, k = min((1000 * a * totals[lang] // (known[p[:k]] * known[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), known[p[:k]], known[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best]):
            found.append((lang, rank + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(map(str, found))


def phrase_rows(seed):
    rng = random.Random(seed)
    word = lambda: f"v{min(40, int(rng.paretovariate(1.1)))}"
    fixed = ["Ünter Den linden", "v1 v2 v3 v4 v5 v6", "new york", "é à"]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice([word(), word(), word(), rng.choice(fixed)]) + rng.choice([" ", " ", "\t ", ", ", ".\n", ": ", " \x1f "]) for _ in range(rng.randrange(60)))
        rows.append((rng.randrange(1000), rng.choice(["en", "en", "de", None]), text))
    return rows + [(5, "fr", None), (None, "fr", ""), (6, "fr", ".,;")] + rows[:20]


@pytest.mark.parametrize("parts, lowered, bits", [(8, 0.4, 27), (1, 1.0, 7), (60, 2.0, 27)])
def test_phrases_against_plain_python(spark, monkeypatch, parts, lowered, bits):
    rows = phrase_rows(parts)
    monkeypatch.setattr(collocations, "MAX_BITS", bits)
    monkeypatch.setattr(collocations, "MIN_BITS", 7)
    monkeypatch.setattr(collocations, "BATCH_BYTES", 3000)
    monkeypatch.setattr(collocations, "PAIRED_WORDS", 1_000_000 if parts != 60 else 3)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    found = collocations.collocations(docs, min_count=12, best=60, sample_parts=parts, lowered=lowered).collect()
    expected = plain_phrases([row[1:] for row in rows], 12, 60)
    assert sorted(str(tuple(r)) for r in found) == expected and len(expected) > 60


def test_failures_of_the_border_are_expanded(spark, monkeypatch):
    """A sample that proposes nothing leaves all to the expansion passes."""
    rows = phrase_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    passes = []
    count = collocations.count_phrases
    monkeypatch.setattr(collocations, "count_phrases", lambda *a: passes.append(len(a[3])) or count(*a))
    found = collocations.collocations(docs, min_count=12, sample_parts=8, lowered=1000.0).collect()
    assert sorted(str(tuple(r)) for r in found) == plain_phrases([row[1:] for row in rows], 12, 2000)
    assert max(passes) >= 3


@pytest.mark.parametrize("parts, lowered, bits", [(8, 1000.0, 27), (8, 2.0, 27), (4, 1.5, 9)])
def test_few_failures_are_expanded_in_one_pass(spark, monkeypatch, parts, lowered, bits):
    """A pass that looks ahead counts phrases of all sizes, whatever the sample proposed."""
    rows = phrase_rows(parts + bits)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    passes = []
    count = collocations.count_phrases
    monkeypatch.setattr(collocations, "AHEAD", 0, raising=False)
    monkeypatch.setattr(collocations, "MAX_BITS", bits)
    monkeypatch.setattr(collocations, "MIN_BITS", 7)
    monkeypatch.setattr(collocations, "BATCH_BYTES", 3000)
    monkeypatch.setattr(collocations, "count_phrases", lambda *a: passes.append(len(a[3])) or count(*a))
    found = collocations.collocations(docs, min_count=12, sample_parts=parts, lowered=lowered).collect()
    assert sorted(str(tuple(r)) for r in found) == plain_phrases([row[1:] for row in rows], 12, 2000)
    assert passes.count(1) == 1 and max(passes) == 1


def test_words_of_one_hash_are_counted_apart():
    import numpy as np

    words = np.array([1, 2, 0, 1, 3, 0, 1, 2, 0])
    first, counts = collocations.Batch._groups(words, np.array([0, 3, 6]), np.zeros(3, np.uint64), 2)
    assert sorted(zip(first.tolist(), counts.tolist())) == [(0, 2), (3, 1)]


def test_phrases_of_edges(docs, none):
    found = collocations.collocations(docs).collect()
    text = [("en", LONG), ("en", "a b"), ("en", "a b"), ("en", "a \t"), ("en", " b"), ("fr", "1 2 3"), (None, "a b")]
    assert sorted(str(tuple(r)) for r in found) == plain_phrases(text, 100, 2000) and len(found) == 4
    assert collocations.collocations(none).count() == 0
