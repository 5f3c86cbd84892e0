import random

import xxhash

from factloom.llm import simhash
from factloom.llm.components import components
from tests.llm.frames import awkward, docs, prose


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    ids, values = zip(*prints, strict=True)
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, f"{v:016x}", least[root(i)]) for i, (d, v) in enumerate(zip(ids, values, strict=True)))


def test_awkward_rows_and_near_copies(spark):
    r = random.Random(3)
    texts = []
    for n in range(60):
        words = prose(n % 20, 400).split()
        words[r.randrange(400)] = f"changed{n}"
        texts.append(" ".join(words))
    frame = awkward(spark).select("doc_id", "text").unionByName(docs(spark, texts, list(range(100, 160))).select("doc_id", "text"))
    rows = [(x.doc_id, slow_fingerprint(x.text)) for x in frame.collect()]
    got = sorted(tuple(x) for x in simhash.near_duplicates(frame).collect())
    assert got == slow_components(rows)


def test_links_of_hot_lists_are_dealt_in_blocks(spark, monkeypatch):
    """Many fingerprints with equal bytes, in blocks of 16: the same components as all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r = random.Random(5)
    prints = sorted({0x0123456789ABCDEF ^ sum(1 << b for b in r.sample(range(20), r.randrange(9))) for _ in range(300)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    labels = {x.node: x.label for x in components(simhash.links(frame, len(prints))).collect()}
    expected = slow_components(list(enumerate(prints)))
    groups = {}
    for i, _, c in expected:
        groups.setdefault(c, set()).add(labels.get(prints[i], prints[i]))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(path, "a long, b long")).collect()
    labels = {x.node: x.label for x in found}
    assert len(found) == 201 + 50 and len({labels[i] for i in range(201)}) == 1
    assert len({labels[1000 + i] for i in range(50)}) == 1 and labels[0] != labels[1000]


def test_empty(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
