"""Fill-in-the-middle: rotations, exact restoring, and the contract in plain Python."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import fim


def plainly(doc_id, text):
    """(n, form, prefix, middle, output) straight from the rule."""
    text = text or ""
    n = len(text)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not n or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_rotation(monkeypatch):
    rng = random.Random(1)
    for block in (1, 3, 1 << 16):
        monkeypatch.setattr(fim, "BLOCK", block)
        for _ in range(200):
            data = bytes(rng.randrange(256) for _ in range(rng.randint(0, 40)))
            a, b, c = sorted(rng.randint(0, len(data)) for _ in range(3))
            buffer = bytearray(data)
            fim.rotate(buffer, a, b, c)
            assert buffer == data[:a] + data[b:c] + data[a:b] + data[c:]
            fim.rotate(buffer, a, a + c - b, c)
            assert buffer == data


def test_scan(monkeypatch):
    rng = random.Random(2)
    for block in (1, 4, 1 << 16):
        monkeypatch.setattr(fim, "BLOCK", block)
        for _ in range(200):
            text = "".join(rng.choice("aé中\U0001f600") for _ in range(rng.randint(0, 20)))
            a, b = sorted(rng.randint(0, len(text)) for _ in range(2))
            body = np.frombuffer(text.encode(), np.uint8)
            assert fim.scan(body, (a, b)) == [len(text[:a].encode()), len(text[:b].encode())]


def test_back_from_the_output_alone():
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choice("<>PSM<>é") for _ in range(rng.randint(1, 12))).encode()
        if any(s in text for s in fim.SENTINELS):
            continue
        cuts = [i for i in range(len(text) + 1) if i == len(text) or text[i] & 0xC0 != 0x80]
        a, b = sorted((rng.choice(cuts), rng.choice(cuts)))
        for form in (fim.PSM, fim.SPM):
            assert fim.original(bytes(fim.arrange(text, a, b, form)), form) == text


def test_frames(spark, odd, empty):
    more = [(i, t) for i in range(300) for t in ("short é text \U0001f600", "x", f"a <P> {i}", "<" * (i % 7), "中" * i)]
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    for docs, rows in ((odd, texts), (spark.createDataFrame(more, "doc_id long, text string"), more)):
        made = fim.restore(fim.fill_in_middle(docs)).collect()
        got = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars or 0, r.middle_chars or 0, r.output, r.restored) for r in made)
        want = [(str(i), *plainly(i, t), t or "") for i, t in rows]
        assert got == sorted((i, n, f, p or 0, m or 0, o, t) for i, n, f, p, m, o, t in want)
        assert all((r.prefix_chars is None) == (r.form == "plain") for r in made)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert fim.restore(fim.fill_in_middle(empty)).count() == 0
    assert fim.restore(spark.createDataFrame([(None, "psm"), ("x", None)], "output string, form string")).where("restored is null").count() == 2
    with pytest.raises(ValueError, match="already there"):
        fim.fill_in_middle(docs.withColumn("n", docs.doc_id), keep=("doc_id", "n"))
