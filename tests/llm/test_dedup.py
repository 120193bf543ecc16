import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonecast.llm import components, exact_dedup, jaccard_join, sharedkeys, substring_dedup
from tests.llm import data


def test_exact_names_equal_texts_alike(spark, tmp_path):
    df = data.docs(spark, path=tmp_path / "d")
    for block in (exact_dedup.BLOCK, 16):                     # 16 bytes: many levels of names
        got = sorted(map(tuple, exact_dedup.exact_dedup(df, block).collect()), key=str)
        groups = defaultdict(list)
        for r in data.rows():
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
        want = []
        for text, ids in groups.items():
            ids = sorted(ids, key=lambda x: (x is None, x or 0))
            sha = hashlib.sha256(text.encode()).hexdigest()
            want += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
        assert got == sorted(want, key=str)


def test_exact_hot_blocks_meet(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SALTS", 3)
    copies = [(i, "the same text " * 50, "en", "s", 0) for i in range(300)] + [(400, "another", "en", "s", 0)]
    got = exact_dedup.exact_dedup(data.docs(spark, copies, tmp_path / "d"), 64).collect()
    assert Counter((r.keep_id, r.group_size) for r in got) == {(0, 300): 300, (400, 1): 1}
    assert [r.doc_id for r in got if r.kept and r.group_size > 1] == [0]


def test_exact_keeps_all_columns(spark, tmp_path):
    df = data.docs(spark, path=tmp_path / "d")
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    found = [(r[0], r[1]) for r in kept.collect()]
    assert len(found) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in found})
    assert len(found) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in data.rows()})


@pytest.mark.parametrize("size,similar", [(3, (9, 10)), (5, (8, 10)), (1, (1, 2))])
def test_near_duplicates_by_all_pairs(spark, tmp_path, size, similar):
    rows = data.rows()
    got = jaccard_join.near_duplicates(data.docs(spark, rows, tmp_path / "d"), size, similar).collect()
    part = data.grouped([r[1] for r in rows], size, *similar)
    least = {}
    for r, p in zip(rows, part, strict=True):
        least[p] = min(least.get(p, 10 ** 9), 10 ** 9 if r[0] is None else r[0])
    want = Counter((r[0], len(data.shingles(r[1], size)), None if least[p] == 10 ** 9 else least[p])
                   for r, p in zip(rows, part, strict=True))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert sum(r.first for r in got) == len(set(part))


def test_a_second_cluster_just_below_the_bound_without_pairs(spark, tmp_path, monkeypatch):
    """Near copies of one text and of another that lies just below the bound to it: one leader, then one of their own."""
    a = data.prose(70, 120).split(" ")
    b = a[:50] + [f"other{k}" for k in range(8)] + a[58:]              # 10 of 118 shingles differ on each side
    rows = [(k, " ".join(a[:100 + k % 3]) + f" end{k}", "en", "s", 0) for k in range(40)]
    rows += [(100 + k, " ".join(b[:100 + k % 3]) + f" end{k}", "en", "s", 0) for k in range(120)]
    made = []
    compared = jaccard_join._compared
    monkeypatch.setattr(jaccard_join, "_compared", lambda texts, pairs, *r: (made.append(pairs.count()), compared(texts, pairs, *r))[1])
    got = jaccard_join.near_duplicates(data.docs(spark, rows, tmp_path / "d")).collect()
    part = data.grouped([r[1] for r in rows], 3, 9, 10)
    assert {r.doc_id: r.component_id for r in got} == {r[0]: rows[p][0] for r, p in zip(rows, part, strict=True)}
    assert sum(made) < 10 * len(rows)                                 # 7,140 pairs in the second cluster alone


def test_a_group_apart_from_its_leader_is_paired_in_a_later_round(spark):
    """70 sets that no leader links, equal in what the leader lacks: a leader of their own first, then their pairs."""
    rows = [(0, k, True, 100, 100, 20, [7]) for k in range(1, 71)]
    compared = spark.createDataFrame(rows, "a long, b long, led boolean, n_a long, n_b long, differ long, prefix array<long>")
    flat = bytes([1] * jaccard_join.BUCKETS)
    used = spark.createDataFrame([(k, 100, flat if k % 2 else bytes(jaccard_join.BUCKETS)) for k in range(71)], "rid long, n long, histogram binary")
    first, most = jaccard_join._beside(compared, used, (9, 10), jaccard_join.BESIDE, None)
    assert most == 70 * jaccard_join.BESIDE and first.where("led").count() == first.count() == 69
    pairs = jaccard_join._beside(compared, used, (9, 10), 4 * jaccard_join.BESIDE, 70 * 70)[0]
    assert pairs.where("led").count() == 0
    assert {(r.a, r.b) for r in pairs.collect()} == {(i, j) for i in range(1, 71) for j in range(i + 1, 71) if i % 2 == j % 2}
    assert jaccard_join._beside(compared, used, (9, 10), 4 * jaccard_join.BESIDE, 70 * 70 - 1)[0].where("led").count() == 69


def test_texts_with_a_passage_in_common_are_not_compared(spark, tmp_path, monkeypatch):
    """Half of each text is its own, so none links and no leader is asked; two copies beside them are."""
    passage = data.prose(900, 60)
    rows = [(k, passage + " " + " ".join(f"own{k}x{j}" for j in range(60)), "en", "s", 0) for k in range(40)]
    rows += [(100 + k, data.prose(901, 150) + f" end{k}", "en", "s", 0) for k in range(2)]
    made = []
    compared = jaccard_join._compared
    monkeypatch.setattr(jaccard_join, "_compared", lambda texts, pairs, *r: (made.append(pairs.count()), compared(texts, pairs, *r))[1])
    for size, similar in ((3, (9, 10)), (5, (8, 10))):
        made.clear()
        got = jaccard_join.near_duplicates(data.docs(spark, rows, tmp_path / f"d{size}"), size, similar).collect()
        assert {r.doc_id: r.component_id for r in got} == {r[0]: min(r[0], 100) for r in rows}
        assert sum(made) == 1


def test_texts_alone_by_their_own_shingles_give_no_keys(spark, tmp_path, monkeypatch):
    passage = data.prose(900, 60)
    rows = [(k, passage + " " + " ".join(f"own{k}x{j}" for j in range(60)), "en", "s", 0) for k in range(40)]
    rows += [(100 + k, data.prose(901, 150) + f" end{k}", "en", "s", 0) for k in range(2)]
    held, written = [], jaccard_join.written

    def kept(df, name):
        out = written(df, name)
        if name == "held":
            held.extend(r.node for r in out.select("node").distinct().collect())
        return out
    monkeypatch.setattr(jaccard_join, "written", kept)
    got = jaccard_join.near_duplicates(data.docs(spark, rows, tmp_path / "d"), 5, (8, 10)).collect()
    assert {r.doc_id: r.component_id for r in got} == {r[0]: min(r[0], 100) for r in rows}
    assert len(held) == 2


def test_members_of_one_part_or_with_many_own_shingles_are_not_paired(spark):
    rows = [(0, k, True, 100, 100, 20, [7]) for k in range(1, 11)]
    compared = spark.createDataFrame(rows, "a long, b long, led boolean, n_a long, n_b long, differ long, prefix array<long>")
    used = spark.createDataFrame([(k, 100, bytes(jaccard_join.BUCKETS)) for k in range(11)], "rid long, n long, histogram binary")

    def pairs(known):
        known = spark.createDataFrame([(k, *known(k)) for k in range(11)], "node long, part long, own long")
        return {(r.a, r.b) for r in jaccard_join._beside(compared, used, (9, 10), jaccard_join.BESIDE, None, known)[0].collect()}

    assert pairs(lambda k: (1, 0)) == set()
    assert pairs(lambda k: (min(k, 9), 0)) == {(i, j) for i in range(1, 11) for j in range(i + 1, 11)} - {(9, 10)}
    assert pairs(lambda k: (k, 2 if k > 8 else 9)) == {(9, 10)}


def test_near_copies_around_a_hub_without_pairs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharedkeys, "SAMPLE", 1)              # keys of 16 sets are hot
    base = data.prose(50, 140)
    rows = [(k, data.edited(base, k, k % 5) + (f" x{k}" if k % 3 else ""), "en", "s", 0) for k in range(1, 160)]
    rows += [(500 + k, data.prose(600 + k, 12 + k), "en", "s", 0) for k in range(60)]
    got = jaccard_join.near_duplicates(data.docs(spark, rows, tmp_path / "d")).collect()
    part = data.grouped([r[1] for r in rows], 3, 9, 10)
    assert {r.doc_id: r.component_id for r in got} == {r[0]: rows[p][0] for r, p in zip(rows, part, strict=True)}
    assert len(set(part)) > 65                                 # some copies are apart, some linked by others


def test_keep_one_of_each_group(spark, tmp_path):
    df = data.docs(spark, path=tmp_path / "d")
    kept = jaccard_join.keep_one(df, size=5, similar=(8, 10))
    assert kept.columns == df.columns
    assert kept.count() == len(set(data.grouped([r[1] for r in data.rows()], 5, 8, 10)))


def test_every_linked_pair_shares_a_key():
    """Pigeonhole, with and without one-deletion neighbourhoods: sizes around the band edges, as far apart as allowed."""
    pick = np.random.default_rng(3)
    for similar in ((9, 10), (8, 10), (1, 2)):
        bands = jaccard_join.Bands(similar)
        a, b = similar
        for n in (1, 2, 5, 8, 9, 10, 11, 19, 20, 21, 37, 60, 111, 200):
            for _ in range(12):
                x = pick.integers(0, 2 ** 63, n).astype(np.uint64)
                big = int(pick.integers(n, n * b // a + 1))
                common = -(-a * (n + big) // (a + b))
                if common > n:
                    continue
                y = np.concatenate([x[:common], pick.integers(0, 2 ** 63, big - common).astype(np.uint64)])
                owner = np.repeat([0, 1], [n, big])
                for sets in (1, 10 ** 9):
                    who, key, role = jaccard_join._keys(bands, owner, np.concatenate([x, y]), np.array([n, big]), sets)
                    asked = set(key[(who == 0) & (role & 2 > 0)])
                    asked_y = set(key[(who == 1) & (role & 2 > 0)])
                    there = set(key[(who == 1) & (role & 1 > 0)])
                    there_x = set(key[(who == 0) & (role & 1 > 0)])
                    assert asked & there or (n == big and asked_y & there_x), (similar, n, big, common)


def test_a_task_holds_the_shingles_of_few_texts():
    texts = [data.prose(k, 300) for k in range(5_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5_000)), pa.array(range(5_000)), pa.array([b"k"] * 5_000), pa.array(texts)],
                                       names=["rid", "doc_id", "text_key", "text"])
    run = jaccard_join._set_rows(5, jaccard_join.Bands((8, 10)), 5_000)
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 5_000 and batch.nbytes > 7 << 20
    assert peak < 64 << 20


def test_rows_of_wanted_keys_are_found_without_a_shuffle(spark):
    rows = spark.range(20_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("k"), "id")
    rows = rows.unionByName(rows.where("id % 70 = 0"))
    for wanted, hits in ((rows.where("id % 7 = 0"), 2858 + 286), (rows.where("id = 5"), 1), (rows.where("id < 0"), 0)):
        got = sharedkeys.likely(rows, wanted.select("k"), "k")
        assert got.columns == rows.columns
        assert got.join(wanted, "k", "left_semi").count() == hits <= got.count() <= hits + 20_000 // 30
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" not in plan and "SortMergeJoin" not in plan


def test_one_text_a_task_is_sent_of_equal_ones(spark, tmp_path):
    docs = data.docs(spark, [(k, "one text for all", "en", "s", 0) for k in range(50)] + [(50, "not wanted", "en", "s", 0)], tmp_path / "d")
    used = spark.createDataFrame([(7,)], "rid long").withColumn("text_key", F.unhex(F.sha2(F.lit("one text for all"), 256)))
    assert [tuple(r) for r in jaccard_join._texts(jaccard_join.picked(docs, "doc_id", "text"), used).collect()] == [(7, "one text for all")]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(100, 100 + k) for k in range(1, 20)] + [(50, 110)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.part for r in got} == {**{i: 1 for i in range(1, 31)}, **{100 + k: 50 for k in range(20)}, 50: 50}


def test_components_in_one_task_and_by_stars(spark, monkeypatch):
    pick = np.random.default_rng(5)
    ends = {(int(min(e)), int(max(e))) for e in pick.integers(0, 400, (300, 2)) if e[0] != e[1]} | {(k, k + 1) for k in range(1000, 1200)}
    links = spark.createDataFrame(sorted(ends), "a long, b long")
    ran = []
    monkeypatch.setattr(components, "_stars", lambda *a, f=components._stars: (ran.append(1), f(*a))[1])
    one = {(r.node, r.part) for r in components.components(links).collect()}
    assert not ran                                            # few links: no rounds of shuffles
    monkeypatch.setattr(components, "ONE_TASK", 0)
    assert {(r.node, r.part) for r in components.components(links).collect()} == one and ran
    assert len(one) == components.components(links).count() == len({n for e in ends for n in e})


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_windows_go(spark, tmp_path, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(sharedkeys, "SAMPLE", 1)
    rows = data.rows()
    got = substring_dedup.substring_dedup(data.docs(spark, rows, tmp_path / "d")).collect()
    count = Counter(tuple(w[k:k + 35]) for r in rows for w in [data.words(r[1])] for k in range(len(w) - 34))
    want = Counter()
    for r in rows:
        w = data.words(r[1])
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_equal_hot_strings_of_a_slice_travel_once(spark):
    passage = data.prose(72, 60)
    rows = [(k, f"{passage} {data.prose(700 + k, 40)}", [(0, 20, 5, True), (20, 6, 6, True)]) for k in range(50)]
    texts = spark.createDataFrame(rows, "sid long, text string, runs array<struct<start:int,size:int,mini:long,hot:boolean>>").coalesce(1)
    packed = substring_dedup._pack(texts, 35, True).collect()
    assert sum(r.packed is not None for r in packed) == 2 and len(packed) == 100
    assert all(r.more for r in packed if r.packed is not None)
    marks = substring_dedup._count_hot(substring_dedup._pack(texts, 35, True), 35).collect()
    found = defaultdict(set)
    for r in marks:
        found[r.sid].update(r.starts)
    assert found == {k: set(range(26)) for k in range(50)}


def test_super_kmers_cover_each_window_once():
    import pyarrow as pa

    texts = [data.prose(9, 200, "ab"), "x " * 90, data.prose(3, 34), None, data.prose(4, 35)]
    owner, start, size, mini = substring_dedup.super_kmers(pa.array(texts), 35, 14)
    seen = Counter((int(o), int(s) + k) for o, s, n in zip(owner, start, size, strict=True) for k in range(n))
    assert seen == Counter((i, k) for i, t in enumerate(texts) for k in range(len(data.words(t)) - 34))


def test_empty_tables(spark):
    none = data.docs(spark, [])
    assert exact_dedup.exact_dedup(none).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0
    assert substring_dedup.substring_dedup(none).count() == 0
    assert exact_dedup.keep_first(none).columns == none.columns


def test_random_texts_are_left_alone(spark, tmp_path):
    rows = [(k, data.prose(1000 + k, random.Random(k).randint(36, 90)), "en", "s", 0) for k in range(60)]
    df = data.docs(spark, rows, tmp_path / "d")
    assert {r.n_removed for r in substring_dedup.substring_dedup(df).collect()} == {0}
    assert all(r.doc_id == r.component_id for r in jaccard_join.near_duplicates(df).collect())
