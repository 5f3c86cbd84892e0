import hashlib
import random

import numpy as np
import pytest

from factloom.llm import substring
from factloom.llm.fm_index import FMIndex
from tests.llm.frames import awkward, docs, prose


def slow(rows):
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = tuple((text or "").encode().split())
        for i in range(len(words) - 12):
            if doc_id is not None:
                first.setdefault(words[i : i + 13], doc_id)
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        kept = [True] * len(words)
        for i in range(len(words) - 12):
            if doc_id is not None and first[tuple(words[i : i + 13])] < doc_id:
                kept[i : i + 13] = [False] * 13
        rest = b" ".join(w for w, k in zip(words, kept, strict=True) if k)
        out.append((doc_id, len(words), kept.count(False), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def passages(n):
    r = random.Random(7)
    shared = [prose(100 + k, 60) for k in range(4)]
    texts = [None, "", "a b c"]
    for k in range(n):
        parts = [prose(1000 + k, r.randrange(5, 60)), shared[0] if k % 3 == 0 else shared[r.randrange(4)][: r.randrange(400)], prose(2000 + k, 9)]
        texts.append(r.choice([" ", "\n", "  "]).join(parts))
    return texts + [texts[5], texts[6] + " " + texts[7], "the same " * 200, "the same " * 100]


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:  # several buckets, groups, shards and chunks, and anchors that count as hot
        for name, value in {"BUCKET_BYTES": 20_000, "GROUP_BYTES": 8_000, "SHARD_BYTES": 9_000, "CHUNK_BYTES": 3_000, "HOT": 3}.items():
            monkeypatch.setattr(substring, name, value)
    frame = docs(spark, passages(60))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert sorted((tuple(r) for r in substring.remove_repeats(frame).collect()), key=repr) == slow(rows)


def test_awkward_rows(spark):
    frame = awkward(spark).unionByName(awkward(spark).where("doc_id = 7").selectExpr("CAST(NULL AS long) AS doc_id", "text", "lang", "source", "n_chars", "shard", "size", "fp", "label", "row", "list"))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = substring.remove_repeats(frame, keep_text=True).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == slow(rows)
    assert all(r.kept == dict(rows)[r.doc_id] for r in got if r.n_removed == 0)
    assert substring.remove_repeats(docs(spark, [])).count() == 0


def test_index_counts_places():
    r = np.random.default_rng(1)
    text = np.r_[r.integers(1, 6, 500), 0].astype(np.int32)
    index = FMIndex(text, 5)
    for length in range(1, 6):
        for start in range(0, 490, 7):
            low, high = np.zeros(1, np.int64), np.full(1, len(text))
            for word in text[start : start + length][::-1]:
                low, high = index.extend(np.array([word], np.int64), low, high)
            places = [i for i in range(500 - length + 1) if (text[i : i + length] == text[start : start + length]).all()]
            assert sorted(index.places[low[0] : high[0]].tolist()) == places
