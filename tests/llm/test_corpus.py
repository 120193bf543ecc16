import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import data
from zonecast.llm import catalog, mixing, packing, pii, sharding
from zonecast.llm.storage import numbered


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check_packing(got, texts, tokenizer, room):
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for k, r in enumerate(sorted(pieces.pop(doc), key=lambda r: r.piece)):
            part = ids[at:at + r.length]
            assert (r.piece, r.start, len(part)) == (k, at, r.length)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert r.length == room or k == 0
            at += r.length
        assert at == len(ids)
    assert not pieces
    rows = defaultdict(list)
    for r in got:
        rows[r.sequence_id].append((r.offset, r.length))
    for held in rows.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= room
    return len(rows), -(-sum(r.length for r in got) // room)


def test_packing_round_trip(spark, tokenizer, tmp_path):
    rows = [(k, *r[1:]) for k, r in enumerate(data.rows())]
    got = packing.pack(data.docs(spark, rows, tmp_path / "d")).collect()
    used, least = check_packing(got, {r[0]: r[1] for r in rows}, tokenizer, 2048)
    assert used <= least + 1
    assert packing.pack(data.docs(spark, [])).count() == 0
    assert packing.pack(data.docs(spark)).agg(F.countDistinct("sequence_id", "offset").alias("n")).first().n == \
        packing.pack(data.docs(spark)).count()


def test_packing_of_the_table(spark, tokenizer):
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    used, least = check_packing(packing.op4_packing(spark, data.SMALL).collect(),
                                {r.doc_id: r.text for r in docs.collect()}, tokenizer, 2048)
    assert used <= least + 1


def test_packing_finds_added_tokens(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"{end}\n  {end} \n", f"one two\n{end}three  four{end}", "<|endoftext| >", "<|<|endoftext|>|>",
             f"{data.prose(8, 900)}{end} {data.prose(9, 900)}", f"é{end}漢\u3000{end}", "no token here", None]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, data.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert default.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for got in (packing.op4_packing(spark, str(tmp_path)), corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))):
        check_packing(got.collect(), dict(enumerate(texts)), default, 2048)


def test_fullest_combination():
    pick = np.random.default_rng(4)
    for _ in range(60):
        room, counts = 40, [0, *pick.integers(0, 3, 40).tolist()]
        sums = {0}
        for length, n in enumerate(counts):
            for _ in range(n):
                sums |= {s + length for s in sums if s + length <= room}
        mix = packing.fullest(counts, room)
        assert sum(x * n for x, n in mix) == max(sums)
        assert all(n <= counts[x] for x, n in mix)
        used = Counter()
        for bins, parts in packing.minimum_bin_slack(counts, room):
            assert sum(x * n for x, n in parts) <= room
            for x, n in parts:
                used[x] += bins * n
        assert [used[x] for x in range(1, 41)] == counts[1:]


def test_shards(spark, tmp_path):
    rows = data.rows()
    got = sharding.shard_by_bytes(data.docs(spark, rows, tmp_path / "d"), shards=4).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(data.docs(spark, [])).count() == 0


def test_shards_are_even_and_keep_equal_texts(spark, tmp_path):
    rows = [(k, data.prose(k % 900, 40), "en", "s", 0) for k in range(3000)]          # groups of 3 or 4
    rows += [(9000 + k, "copied text " * 20, "en", "s", 0) for k in range(1500)]      # a third: must be cut
    got = sharding.shard_by_bytes(data.docs(spark, rows, tmp_path / "d")).collect()
    size, place = Counter(), defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        if r.doc_id < 9000:
            place[r.text_crc32].add(r.shard)
    assert set(size) == set(range(24))
    mean = sum(size.values()) / 24
    assert max(size.values()) <= 1.06 * mean and min(size.values()) >= 0.94 * mean
    assert {len(s) for s in place.values()} == {1}


def test_large_groups_are_cut_only_where_a_shard_is_full(spark, tmp_path):
    rows = [(k, data.prose(k, 30), "en", "s", 0) for k in range(600)]
    rows += [(1000 + 100 * g + k, f"group {g} " * 12, "en", "s", 0) for g in range(8) for k in range(30 + 4 * g)]
    rows += [(5000 + k, "the hot text " * 9, "en", "s", 0) for k in range(900)]
    got = sharding.shard_by_bytes(data.docs(spark, rows, tmp_path / "d"), shards=6, part_rows=50).collect()
    size, slots, place = Counter(), defaultdict(list), defaultdict(Counter)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        place[r.text_crc32][r.shard] += 1
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / 6
    assert max(size.values()) <= 1.03 * mean and min(size.values()) >= 0.97 * mean
    hot = zlib.crc32(("the hot text " * 9).encode())
    assert {len(s) for t, s in place.items() if t != hot} == {1}
    assert 2 <= len(place[hot]) <= 4                          # a group of 2.4 shards


def test_no_group_that_fits_in_a_shard_parts(spark):
    got = sharding.op10_sharding(spark, "/root/testdata/sf0.01")
    assert got.groupBy("text_crc32", "size").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    size = [r["sum(size)"] for r in got.groupBy("shard").sum("size").collect()]
    assert len(size) == 24 and max(size) <= 1.05 * sum(size) / 24 + 33_100      # the longest text of them


def test_planned_groups():
    pieces, held = sharding.plan_groups([(1, 50), (2, 250), (3, 40), (4, 90)], 400, 4)
    assert pieces[1] != pieces[3] and all(len(pieces[h]) == 1 for h in (1, 3, 4)) and len(pieces[2]) >= 3
    assert sum(held) == 430 and sorted(a for a, _ in pieces[2])[0] == 0
    assert sharding.plan_groups([], 0, 3) == ({}, [0, 0, 0])


def raked(cells, languages, topics, rounds):
    keys = sorted(cells)
    weight = {c: float(cells[c]) for c in keys}
    mass = Counter()
    for (s, *_), t in cells.items():
        mass[s] += t
    goal = {s: m ** mixing.TEMPER for s, m in mass.items()}
    named = [{s: g / sum(goal.values()) for s, g in goal.items()}, languages, topics]
    for _ in range(rounds):
        for axis, target in enumerate(named):
            now = Counter()
            for c in keys:
                now[c[axis]] += weight[c]
            total = sum(target[v] for v in now)
            weight = {c: weight[c] * target[c[axis]] / total / now[c[axis]] for c in keys}
    return {c: weight[c] / cells[c] for c in keys}


def test_weights_by_raking(spark):
    pick = np.random.default_rng(6)
    languages, topics = {"en": 0.5, "de": 0.3, "fr": 0.2}, {"long": 0.4, "prose": 0.6}
    cells = {(f"s{s}", x, k): int(pick.integers(50, 5000)) for s in range(5) for x in languages for k in topics}
    table = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.fit_weights(table, languages, topics).collect() if (r.source, r.lang, r.topic) in cells}
    want = raked(cells, languages, topics, mixing.ROUNDS)
    scale = sum(cells[c] * got[c] for c in cells) / sum(cells[c] * want[c] for c in cells)
    assert [got[c] / scale for c in cells] == pytest.approx([want[c] for c in cells], rel=1e-6)


def test_sampling_follows_the_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.with_probability(docs).collect()
    assert all(0 <= r.p <= 1 for r in rows) and max(r.p for r in rows) == 1.0
    expected, taken = sum(r.p for r in rows), sum(r.u < r.p for r in rows)
    assert abs(expected - taken) < 4 * sum(r.p * (1 - r.p) for r in rows) ** 0.5
    assert sorted(r.doc_id for r in mixing.sample(docs).collect()) == sorted(r[0] for r in rows if r.u < r.p)


def test_empty_cells_do_not_scale_the_sample(spark):
    rows = mixing.with_probability(spark.read.parquet(f"{data.SMALL}/documents.parquet")).collect()
    assert max(r.p for r in rows if r.tokens) == 1.0


def test_margins_without_tokens_have_no_weight(spark, tmp_path):
    rows = [(k, data.prose(k, 20 + k), ("en", "de")[k % 2], f"s{k % 3}", 0) for k in range(12)]
    rows += [(20, "", None, "s0", 0), (21, "", "en", "s1", 0), (22, " ", "fr", "s9", 0)]
    spark.createDataFrame(rows, data.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(mixing.oracle_sql())
    columns = [d[0] for d in want.description]
    got = mixing.op7_mixing(spark, str(tmp_path)).select(columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


def test_mixing_scale_is_that_of_held_cells(spark, tmp_path):
    """A source of one document, and most combinations of margins empty: some document is surely taken, in query and SQL."""
    rows = [(k, f"{data.prose(k, 40 + k)}{' licence' * (k % 9 == 0)}", ["en", "de"][k % 2], f"s{k % 3}", 0) for k in range(60)]
    rows += [(90, "a@b.example only one", "fr", "tiny", 0), (91, " ", "es", "tiny", 0)]
    path = tmp_path / "documents.parquet"
    spark.createDataFrame(rows, data.SCHEMA).write.parquet(str(path))
    got = {r.doc_id: r for r in mixing.op7_mixing(spark, str(tmp_path)).collect()}
    assert max(r.probability for r in got.values()) == 1.0
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    want = con.execute(f"select doc_id, probability, selected from ({mixing.oracle_sql()})").fetchall()
    assert {(i, p, s) for i, p, s in want} == {(i, r.probability, r.selected) for i, r in got.items()}


def test_mixing_awkward_rows(spark):
    df = data.docs(spark)
    got = mixing.with_probability(df).collect()
    assert len(got) == len(data.rows())
    assert Counter(r.tokens for r in got) == Counter(len(data.words(r[1])) for r in data.rows())
    assert mixing.sample(df).columns == df.columns
    assert mixing.sample(data.docs(spark, [])).count() == 0
    assert numbered(df).columns[0] == "_c0"


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def seeds(text):
    out = []
    for kind, expression in PLAIN.items():
        for m in re.finditer(expression, text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            luhn = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": max(map(int, m.group().split(".") if kind == "ip" else "0")) <= 255,
                    "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data_seeds(spark, tmp_path):
    hard = ["a@b.com_x@d.ee@f.gg", "1.2.3.4.5.6.7.8", "x" * 90_000 + "@", "1 " * 60_000, "+" * 500 + "1", "+1((((", "a@b.c" * 3000,
            "@@a.b@c.d", "0001.2.3.4 300.1.1.1.1", "4111111111111111 4111 1111 1111 1111-5500-0000-0000-0004", "9" * 50_000,
            "é+49 (30) 123-456.789 ü 漢 a.b@é.de x@y.z", "", None, "tel +1 (262) 555-3752 +1(262)555-37"]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(hard + [r[1] for r in data.rows()])]
    got = {r.doc_id: r for r in pii.personal_data(data.docs(spark, rows, tmp_path / "d")).collect()}
    for k, text, *_ in rows:
        want = seeds(text or "")
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), k
        assert [got[k][f"n_{x}"] for x in PLAIN] == [sum(w.startswith(x) for w in want) for x in PLAIN]
        assert got[k].spans == ",".join(want)
    assert pii.personal_data(data.docs(spark, [])).count() == 0


def test_personal_data_by_context(spark, tmp_path):
    rows = [(k, f"please Call phone: +1 (262) 555-{1000 + k} today", "en", "s", 0) for k in range(8)]
    rows += [(20 + k, f"their phone: 555-{2000 + k} soon", "en", "s", 0) for k in range(3)]         # found by the pattern
    rows += [(30 + k, f"order no: 77{k}88{k} of phone 555-9999", "en", "s", 0) for k in range(6)]   # no pattern of a kind
    rows += [(40, "version 4.0.1 and the year 2024, phone: soon", "en", "s", 0)]
    got = {r.doc_id: r.spans for r in pii.personal_data(data.docs(spark, rows, tmp_path / "d")).collect()}
    for i, text, *_ in rows:
        want = seeds(text) + ([f"phone:{text.index('555-')}:{text.index('555-') + 8}"] if 20 <= i < 30 else [])
        assert got[i] == ",".join(want)


def test_personal_data_by_words_alone(spark, tmp_path):
    """A context without a label mark; inner blanks, brackets; a second round; a frequent word is no pattern."""
    rows = [(k, f"you may ring me under +1 (262) 555-{1000 + k} today", "en", "s", 0) for k in range(8)]
    found = {20: "(030) 123 45", 21: "030 99 17 5", 22: "555-2002"}
    rows += [(i, f"so ring me under {v} or else", "en", "s", 0) for i, v in found.items()]
    rows += [(30 + i, f"her desk line rings {v} daily", "en", "s", 0) for i, v in enumerate(found.values())]      # new pattern
    rows += [(40, "her desk line rings 030-777 daily", "en", "s", 0)]                                         # by the second round
    rows += [(50 + k, f"go to the +1 (262) 555-{3000 + k} or to the 77{k} 88 of the key 04db{k}e of the end", "en", "s", 0) for k in range(5)]
    rows += [(60, "ring me under deadbeef4 or never", "en", "s", 0)]                                          # no phone has letters
    spots = {**found, **{30 + i: v for i, v in enumerate(found.values())}, 40: "030-777"}
    got = {r.doc_id: r.spans for r in pii.personal_data(data.docs(spark, rows, tmp_path / "d")).collect()}
    for i, text, *_ in rows:
        at = text.index(spots[i]) if i in spots else 0
        assert got[i] == ",".join(seeds(text) + ([f"phone:{at}:{at + len(spots[i])}"] if i in spots else [])), i


def test_oracles(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{data.SMALL}/documents.parquet'")
    for name, sql in catalog.ORACLE_SQL.items():
        got = catalog.QUERIES[name](spark, data.SMALL)
        want = con.execute(sql)
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(got.columns)
        assert Counter(map(tuple, got.select(columns).collect())) == Counter(want.fetchall())


def test_pipeline_stages(spark, tokenizer):
    from zonecast.llm.storage import documents, written

    docs = documents(spark, data.SMALL)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, data.SMALL), name)
        assert out.columns == docs.columns
        before, after = ({r.doc_id: r for r in d.collect()} for d in (docs, out))
        assert all(before[i] == r for i, r in after.items())
        if name == "exact":
            same = {}
            for i in sorted(before):
                same.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i].text or ""), i)
            assert set(after) == set(same.values())
        elif name == "near":
            ids = sorted(before)
            assert set(after) == {ids[p] for p in data.grouped([before[i].text for i in ids], 5, 8, 10)}
        elif name == "mix":
            chosen = {r[0] for r in mixing.with_probability(docs).where("u < p").collect()}
            assert set(after) == chosen
        else:
            known = {r.doc_id: r.quality for r in spark.read.parquet(f"{data.SMALL}/labels.parquet").collect()}
            lost = [i for i in before if i not in after and known.get(i) == 1]
            assert len(lost) <= 0.03 * len(before)
        docs = out
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, data.SMALL).collect(), {r.doc_id: r.text for r in docs.collect()}, tokenizer, 2048)


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, data.SMALL).count() > 20


def test_written_steps_do_not_collect_garbage(spark):
    from zonecast.llm.storage import written

    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = full()
    assert written(spark.range(10), "ten").count() == 10
    assert full() == before
