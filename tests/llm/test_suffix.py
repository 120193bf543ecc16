import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm import data
from zonecast.llm import sharedkeys, suffix_array, suffix_dedup


def plain_order(texts):
    out, base = [], 0
    for t in texts:
        out += [base + i for i in sorted(range(len(t)), key=lambda i: t[i:])]
        base += len(t)
    return out


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abc", bytes(range(256))])
def test_suffix_arrays_by_sorting(letters):
    pick = random.Random(len(letters))
    for _ in range(60):
        texts = [bytes(pick.choice(letters) for _ in range(pick.randint(0, 40))) for _ in range(pick.randint(0, 9))]
        symbols = np.frombuffer(b"".join(texts), np.uint8).astype(np.int32) + 1
        assert suffix_array.suffix_arrays(symbols, [len(t) for t in texts]).tolist() == plain_order(texts)


def test_suffix_arrays_of_long_and_regular_texts():
    words = data.prose(3, 2000).encode()
    fib = [b"a", b"ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    texts = [words, words[:4000] * 2, b"x" * 5000, b"xy" * 2500, fib[-1], bytes(range(255, -1, -1)) * 8, b"ab" * 300 + b"\0" + b"ab" * 300]
    symbols = np.frombuffer(b"".join(texts), np.uint8).astype(np.int32) + 1
    assert suffix_array.suffix_arrays(symbols, [len(t) for t in texts]).tolist() == plain_order(texts)


def brute(rows, window):
    """Bytes covered by a window that also starts at a smaller (id, start), counted over all windows."""
    texts = [(-2 ** 63 if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    least = {}
    for i, t in texts:
        for a in range(len(t) - window + 1):
            w = t[a:a + window]
            least[w] = min(least.get(w, (i, a)), (i, a))
    out = Counter()
    for r, (i, t) in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for a in range(len(t) - window + 1):
            if least[t[a:a + window]] < (i, a):
                gone[a:a + window] = True
        left = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out[r[0], len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest()] += 1
    return out


def small():
    """Every awkward row, without the two long ones."""
    return [r for r in data.rows() if len(r[1] or "") < 20_000] + [
        (900, "a" * 3000, "en", "s", 0), (901, "b" + "a" * 500, "en", "s", 0), (902, "xyz" * 400, "en", "s", 0), (903, "zx" + "xyz" * 90, "en", "s", 0),
        (904, "é" * 120, "en", "s", 0), (905, "aé" + "é" * 70, "en", "s", 0)]


def result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("window,gram,part", [(100, 24, 16 << 10), (100, 24, 300), (30, 8, 100), (7, 5, 16 << 10)])
def test_removed_bytes_by_all_windows(spark, tmp_path, window, gram, part):
    rows = small()
    got = suffix_dedup.suffix_dedup(data.docs(spark, rows, tmp_path / "d"), window, gram, part, 1 << 16)
    assert result(got) == brute(rows, window)


def test_hot_minimisers_are_sorted_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharedkeys, "SAMPLE", 1)              # keys of 16 pieces are hot
    passage = data.prose(8, 40)
    rows = [(i, data.prose(1000 + i, 6) + " " + passage + " " + data.prose(2000 + i, 6), "en", "s", 0) for i in range(60)] + small()
    hot = []
    send = suffix_dedup._send
    monkeypatch.setattr(suffix_dedup, "_send", lambda texts, *a: (hot.append(texts.where("size(hot) > 0").count()), send(texts, *a))[1])
    got = suffix_dedup.suffix_dedup(data.docs(spark, rows, tmp_path / "d"), salts=3)
    assert result(got) == brute(rows, 100) and hot[0] >= 60


def test_long_texts_and_spans(spark, tmp_path):
    one, two = data.prose(6, 9_000), "w" * 120_000
    rows = [(0, one, "en", "s", 0), (1, data.prose(7, 20) + one[200:2000] + "?" + one[5000:], "en", "s", 0), (2, two, "en", "s", 0), (3, two[:500], "en", "s", 0)]
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(data.docs(spark, rows, tmp_path / "d")).collect()}
    lead = len(data.prose(7, 20))
    assert got[0].n_removed == 0 and got[0].kept is None and got[0].spans == []
    assert [tuple(s) for s in got[1].spans] == [(lead, lead + 1800), (lead + 1801, len(rows[1][1]))]
    assert bytes(got[1].kept).decode() == data.prose(7, 20) + "?"
    assert (got[2].n_removed, got[2].n_spans) == (120_000 - 1, 1) and got[3].n_removed == 500


def test_no_documents(spark, tmp_path):
    assert suffix_dedup.suffix_dedup(data.docs(spark, [], tmp_path / "d")).collect() == []
    few = [(0, None, "en", "s", 0), (1, "short", "en", "s", 0), (2, "short", "en", "s", 0)]
    assert result(suffix_dedup.suffix_dedup(data.docs(spark, few, tmp_path / "e"))) == brute(few, 100)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data.SMALL}/documents.parquet')")
    got = suffix_dedup.op11_suffix_dedup(spark, data.SMALL)
    want = con.sql(suffix_dedup.ORACLE)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
