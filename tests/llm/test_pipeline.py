"""The pipeline on small tables against plain Python, stage by stage."""

import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import pytest
import tiktoken

import corpus_pipeline
import public_tokenizers
from ledgerfold.llm import language_id
from ledgerfold.llm.queries import codec
from tests.conftest import TESTDATA
from tests.llm.test_queries import plain_components, plain_fingerprint

SF_DIR = f"{TESTDATA}/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
BLANKS = r"[\x20\x09-\x0D]+"


def plain_mix(docs):
    """How often each of (doc_id, source, text) is taken."""
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", text)) for d, _, text in docs}
    by_source = defaultdict(list)
    for d, source, _ in docs:
        by_source[source].append(d)
    names = sorted(by_source)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(size[d] for d in by_source[s]) for s in names}
    target, left = {}, 1.5 * sum(total.values())
    waiting = set(names)
    while waiting:
        level = left / sum(weight[s] for s in waiting)
        above = {s for s in waiting if level * weight[s] > 2 * total[s]}
        if not above:
            target |= {s: level * weight[s] for s in waiting}
            break
        target |= {s: 2.0 * total[s] for s in above}
        left -= sum(target[s] for s in above)
        waiting -= above
    taken = {}
    for s in names:
        rate = target[s] / total[s] if total[s] else 0.0
        offset = int(hashlib.md5(f"42:{s}".encode()).hexdigest()[:4], 16) / 65536
        for i, d in enumerate(sorted(by_source[s], key=lambda d: (-size[d], d))):
            taken[d] = math.floor(offset + (i + 1) * rate) - math.floor(offset + i * rate)
    return taken


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language_id.learn(docs)
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect() if not model.predict(r.text)[2]]
    assert len(rows) >= 0.99 * docs.count()
    first = {}
    for d, source, text in sorted(rows):
        first.setdefault(re.sub(BLANKS, " ", text), (d, source, text))
    unique = sorted(first.values())
    roots = plain_components([plain_fingerprint(text) for *_, text in unique])
    kept = [row for i, row in enumerate(unique) if roots[i] == i]
    assert len(kept) <= len(unique) < len(rows)
    copies = plain_mix(kept)
    ranks = {token: rank for rank, token in enumerate(codec().tokens)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for d, source, text in kept:
        ids = plain.encode_ordinary(text)
        digests = (",".join(map(str, ids)).encode(), text.encode())
        want[(d, source, len(ids), *(hashlib.sha256(x).hexdigest() for x in digests))] += copies[d]
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    got = Counter((r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found)
    assert got == +want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    nothing = docs.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nothing, SF_DIR).columns == docs.columns
