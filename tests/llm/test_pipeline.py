import hashlib
import itertools
import random

import corpus_pipeline
import public_tokenizers
from factloom.llm import language, simhash
from tests.llm.frames import docs, prose
from tokenizers import Tokenizer


def corpus(spark, folder):
    item = prose(99, 40)
    texts = [prose(n, 120) for n in range(30)]
    texts += [None, "123 456", texts[0], texts[1] + " and a little more", prose(7, 30) + " " + item + " " + prose(8, 30)]
    texts += [prose(200, 20) + " " + " ".join(texts[2].split()[:60]) + " " + prose(201, 20)]
    frame = docs(spark, texts)
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return frame


def test_each_stage_takes_effect(spark, tmp_path):
    frame = corpus(spark, str(tmp_path))
    ids, rows = [], frame
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.columns == frame.columns
        rows = spark.createDataFrame(rows.collect(), frame.schema)
        ids.append({r.doc_id for r in rows.collect()})
    assert set(range(36)) - ids[0] == {30, 31}
    assert ids[0] - ids[1] == {32}
    assert ids[1] - ids[2] == set()
    assert ids[2] - ids[3] == {34}
    texts = {r.doc_id: r for r in rows.collect()}
    assert len(texts[35].text.split()) == 40 and texts[35].n_chars == len(texts[35].text)
    assert texts[5].text == {r.doc_id: r.text for r in frame.collect()}[5]
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in result.collect()} == ids[3]


def by_hand(rows, items, model):
    """The rows of the whole pipeline over (doc_id, text), one document at a time."""
    kept = []
    for doc_id, text in rows:
        (name,), (score,) = model.predict([text])
        if name != language.UNKNOWN and score >= language.LEAST_SCORE - len(text) ** -0.5:
            kept.append((doc_id, text))
    prints = [simhash.fingerprint(t) % 2**64 for _, t in kept]
    label = list(range(len(kept)))
    for a, b in itertools.combinations(range(len(kept)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3 and label[a] != label[b]:
            label = [label[a] if x == label[b] else x for x in label]
    best = {}
    for x, p, (doc_id, text) in zip(label, prints, kept, strict=True):
        rank = (doc_id is None, doc_id or 0, f"{p:016x}", text)
        best[x] = min(best.get(x, rank), rank)
    kept = [(None if r[0] else r[1], r[3]) for r in best.values()]
    first = {}
    for doc_id, text in kept:
        words = text.split()
        for i in range(len(words) - 12):
            at = tuple(words[i : i + 13])
            if doc_id is not None:
                first[at] = min(first.get(at, doc_id), doc_id)
    cut = []
    for doc_id, text in kept:
        words = text.split()
        gone = {k for i in range(len(words) - 12) if doc_id is not None and first[tuple(words[i : i + 13])] < doc_id for k in range(i, i + 13)}
        cut.append((doc_id, " ".join(w for k, w in enumerate(words) if k not in gone) if gone else text))
    five = lambda text: {tuple(w[i : i + 5]) for w in [text.lower().split()] for i in range(max(1, len(w) - 4)) if w}
    wanted = [five(item) for item in items]
    kept = [(doc_id, text) for doc_id, text in cut if text and not any(len(w & five(text)) >= 0.8 * len(w) for w in wanted)]
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for doc_id, text in kept:
        ids = encoder.encode(text, add_special_tokens=False).ids
        back = encoder.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids))
    return sorted(out, key=repr)


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    r = random.Random(3)
    item = prose(99, 40)
    texts = [prose(n, r.randrange(1, 150)) for n in range(40)]
    ids = list(range(40))
    texts += [texts[3], texts[4] + " x", texts[5], prose(50, 30), prose(51, 30), prose(50, 30), None, "12 !", texts[6], "²½ ①"]
    ids += [40, 41, 42, 43, 43, 44, 45, 46, 43, 47]  # 43 has two texts of its own, and a copy of 6
    texts += [texts[7], prose(60, 40), prose(60, 40), prose(61, 40), prose(62, 20) + " " + item, None, texts[8] + " " + item]
    ids += [None, None, None, None, None, None, 7]
    texts += [prose(70, 5) + " " + " ".join(texts[2].split()[:60]) + " " + prose(71, 5), item, prose(50, 30)]
    ids += [60, 61, 43]
    frame = docs(spark, texts, ids)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    expected = by_hand(list(zip(ids, texts, strict=True)), [item], language.fit(frame))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    got = sorted((tuple(x) for x in got.collect()), key=repr)
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert got == expected
    assert sum(x[0] is None for x in expected) == 2 and sum(x[0] == 43 for x in expected) == 2


def test_repeated_rows_and_an_empty_table(spark, tmp_path):
    corpus(spark, str(tmp_path))
    twice = docs(spark, [prose(1, 50)] * 2 + [None] * 2, [4, 4, None, None])
    kept = corpus_pipeline.drop_near_duplicates(spark, twice, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (4, prose(1, 50))]
    empty = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_contaminated_rows_without_an_id_go(spark, tmp_path):
    corpus(spark, str(tmp_path))
    leak = prose(7, 30) + " " + prose(99, 40) + " " + prose(8, 30)
    frame = docs(spark, [leak, prose(1, 50), None, leak, prose(2, 50)], [None, None, None, 4, 5])
    kept = corpus_pipeline.decontaminate(spark, frame, str(tmp_path))
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(0, prose(1, 50)), (0, ""), (5, prose(2, 50))])
