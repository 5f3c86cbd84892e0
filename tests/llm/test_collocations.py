import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from factloom.llm import collocations
from tests.llm.frames import awkward, docs

UPPER = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, least=30, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3, 4):
                f[lang].update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if " " in p and a >= least}
        gone = set()
        for q, longer in candidates.items():
            w = q.split(" ")
            for m in range(2, len(w)):
                gone |= {p for i in range(len(w) - m + 1) if 100 * longer >= 80 * candidates[p := " ".join(w[i : i + m])]}
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                w = p.split(" ")
                cuts = [(2_000_000 * a // (counts[" ".join(w[:k])] + counts[" ".join(w[k:])]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                scored.append((-score, -a, p.encode(), counts[" ".join(w[:k])], counts[" ".join(w[k:])]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def sentences(seed, n, vocabulary=25):
    r = random.Random(seed)
    fixed = ["New York City hall", "of the", "in the middle of", "as a rule", "É a", "😀 x"]
    words = [f"w{i}" for i in range(vocabulary)]
    out = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else r.choice(words) + r.choice(["", "", "", ",", ".", "\n", "\t", " "]) for _ in range(r.randrange(0, 25))]
        out.append(" ".join(parts))
    return out


def corpus(spark):
    rows = [(r, t) for r, seed in (("en", 1), ("de", 2), (None, 3), ("und", 4)) for t in sentences(seed, 150)]
    rows += [("en", t) for t in ["", None, "a a a a a a " * 30, "only once here", ".,;", "Ab\x0bcd\x0cef\x85gh ij\xa0kl " * 40]]
    rows += [("en", "copied words stand in many documents alike. " + "x y z. " * 3)] * 120 + [("xx", None), ("yy", ""), ("zz", "one word")]
    frame = spark.createDataFrame([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", "1 AS size", "'x' AS phrase", "2 AS shard", "3 AS n"), rows


@pytest.mark.parametrize("bits", [16, 3])
def test_equals_brute_force(spark, monkeypatch, bits):
    # few places: almost every phrase meets another's first step
    monkeypatch.setattr(collocations, "LEAST_BITS", bits)
    monkeypatch.setattr(collocations, "MOST_BITS", bits)
    frame, rows = corpus(spark)
    assert sorted(tuple(r) for r in collocations.collocations(frame).collect()) == by_hand(rows)


@pytest.mark.parametrize("shards", [1, 5])
def test_other_shards_and_limits(spark, shards):
    frame, rows = corpus(spark)
    got = collocations.collocations(frame, least=4, top=7, shards=shards).collect()
    assert sorted(tuple(r) for r in got) == by_hand(rows, 4, 7)


def test_long_phrases_begin_before_short_ones_end(spark, monkeypatch):
    """The steps in which each length is first counted, and the whole number of steps."""
    seen = []
    counting = collocations._counting
    monkeypatch.setattr(collocations, "_counting", lambda step, *rest: seen.append(step) or counting(step, *rest))
    frame, _ = corpus(spark)
    counts = collocations.count_phrases(frame, shards=4)
    assert counts.where("size = 4").count() > 0
    # one length after the other would take four cycles of four
    assert 4 + 3 <= len(seen) < 16


def test_a_long_text_is_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 10)
    texts = [b"a b c d e f g h. i j k. l", b"m", b"", b"n o. " * 9]
    pieces = lambda parts: [p.split() for t in parts for p in t.split(b".") if p.split()]
    assert pieces(collocations._chunks(texts)) == pieces(texts)


def test_awkward_rows_and_an_empty_table(spark):
    frame = awkward(spark)
    rows = [(r.lang, r.text) for r in frame.collect()]
    assert sorted(tuple(r) for r in collocations.collocations(frame).collect()) == by_hand(rows)
    empty = collocations.collocations(docs(spark, []))
    assert empty.count() == 0
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("bits", [8, 5])
def test_a_place_that_was_marked_early_does_not_cut_the_cycle_of_a_longer_phrase(spark, monkeypatch, bits):
    # some phrases meet the first step of others that were there before their own parts had reached the threshold
    monkeypatch.setattr(collocations, "LEAST_BITS", bits)
    monkeypatch.setattr(collocations, "MOST_BITS", bits)
    rows = [("en", t) for t in sentences(0, 400, 12)]
    frame = spark.createDataFrame([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = collocations.collocations(frame, least=8).collect()
    assert sorted(tuple(r) for r in got) == by_hand(rows, 8)


@pytest.mark.parametrize("held", [2, 100])
def test_the_text_of_each_lang_is_gathered_to_whole_chunks(monkeypatch, held):
    """Langs in turns: a chunk of all would hold a part of each, and give its phrases that often."""
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(collocations, "HELD_CHUNKS", held)
    rows = [(f"l{n % 10}", "one two three. ") for n in range(1000)]
    batches = [pa.RecordBatch.from_pydict({"lang": [lang for lang, _ in rows[k : k + 100]], "text": [t for _, t in rows[k : k + 100]]}) for k in range(0, 1000, 100)]
    given = type("Given", (), {"value": np.zeros(1 << 4, np.uint8).tobytes()})
    found = [r for b in collocations._counting(0, 3, given, 4)(iter(batches)) for r in b.to_pylist()]
    total = Counter()
    for r in found:
        total[r["key"]] += r["n"]
    assert total == {f"l{n}\t{w}": c for n in range(10) for w, c in [("", 300), ("one", 100), ("two", 100), ("three", 100)]}
    if held == 100:
        assert sum(r["key"] == "l0\tone" for r in found) == 2
