import hashlib
import random
import re

import pytest

from factloom.llm import fim
from tests.llm.frames import awkward, docs, prose


def by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i * 8 : i * 8 + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out, lengths = "plain", text, (None, None)
    if text and not any(m in text for m in ("<P>", "<S>", "<M>")) and h[2] % 100 < 50:
        form = "spm" if h[3] % 100 < 80 else "psm"
        out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
        lengths = len(prefix), len(middle)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, n, form, *lengths, sha(out), sha(text), out)


def awkward_texts():
    r = random.Random(5)
    texts = [None, "", " ", "\n\t \x0b\x0c\r", "a", " a", "a ", "<P>", "x<S>y z", "a <M> b", "<", "<<P <S <M", "é 日本語 😀 x y", "\x1c\x1d a\x85b"]
    texts += ["".join(r.choice(["a", "bc", "<", "P", ">", " ", "\n", "é", "😀"]) for _ in range(r.randrange(1, 60))) for _ in range(300)]
    return texts + [prose(n, 400) for n in range(10)] + ["w" * 50_000 + " " * 40_000, prose(3, 20_000)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many frames of a text and of an output; markers lie across their ends
        monkeypatch.setattr(fim, "FRAME_UNITS", 3)
        monkeypatch.setattr(fim, "FRAME_CHARS", 5)
        monkeypatch.setattr(fim, "_FRAME", re.compile(fim._UNIT + "{1,3}+"))
    texts = awkward_texts() if not small else awkward_texts()[:-2]
    rows = list(zip(range(-5, len(texts) - 5), texts, strict=True)) + [(None, "no id a b c"), (7, "again " * 9), (7, "again " * 9)]
    if small:  # patched values do not reach the workers of a running session
        for doc_id, text in rows:
            press = fim.zstandard.ZstdCompressor()
            held = fim.Frames.of_text(text or "", press)
            form, a, b = fim.plan(held, any(m in (text or "") for m in ("<P>", "<S>", "<M>")), doc_id, 42, 50, 80)
            out = fim.Frames.of_stream(fim.output(held, form, a, b), press)
            expected = by_hand(doc_id, text)
            assert (held.units[-1], form) == expected[1:3]
            assert "".join(out.read(0, out.chars[-1])) == expected[-1]
            assert "".join(fim.restored(out, form)) == (text or "")
        return
    frame = docs(spark, [t for _, t in rows], [i for i, _ in rows])
    got = fim.fill_in_middle(frame, keep_output=True).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted((by_hand(*r) for r in rows), key=repr)
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_awkward_rows_and_an_empty_table(spark):
    frame = awkward(spark).selectExpr("*", "1 AS n", "'x' AS frames", "'y' AS form", "2 AS units", "true AS marked")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = fim.fill_in_middle(frame).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted((by_hand(*r)[:-1] for r in rows), key=repr)
    assert fim.fill_in_middle(docs(spark, [])).count() == 0


def test_other_shares(spark):
    frame = docs(spark, [prose(n, 50) for n in range(200)])
    assert {r.form for r in fim.fill_in_middle(frame, rate=100, suffix_first=0).collect()} == {"psm"}
    assert {r.form for r in fim.fill_in_middle(frame, rate=0).collect()} == {"plain"}


def test_a_cut_opens_one_frame(monkeypatch):
    held = fim.Frames.of_text(prose(1, 100_000), fim.zstandard.ZstdCompressor())
    opened = []
    decompress = fim.zstandard.decompress
    monkeypatch.setattr(fim.zstandard, "decompress", lambda d: opened.append(d) or decompress(d))
    at = held.char_of_unit(50_001)
    assert len(held.data) == -(-100_000 // fim.FRAME_UNITS) and len(opened) == 1
    assert "".join(held.read(0, at)).split()[-1] == prose(1, 100_000).split()[50_000]
