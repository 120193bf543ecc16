import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tests.llm import data
from zonecast.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Every node from all prefixes of the rebuilt conversations."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            turns[conv].append(((turn is not None, turn or 0), role, name, text))
    own = {c: [(t[1], t[3]) for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter((c[0], len(p), members[p[:-1]][0] if p else None, len(c), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, c in members.items())


def rows():
    some = [(c, t, ("user", "assistant")[t % 2], f"text {t} of {c // 20}" + "é" * (c % 3)) for c in range(60) for t in range(c % 8)]
    some += [(c, t, "user", f"same {t}") for c in range(100, 400) for t in range(3)]             # one hot conversation
    some += [(c, 0, "system", "the same start") for c in range(500, 560, 5)] + [(c, t, "user", str(c * t)) for c in range(500, 560, 5) for t in (1, 2)]
    some += [(None, 1, "user", "nobody's"), (701, None, "user", None), (701, 3, None, "x" * 100_000), (702, 1, None, None),
             (703, 5, "b", "tie"), (703, 5, "a", "tie"), (705, 1, "user", "twice"), (705, 1, "user", "twice"), (709, 1, "", "")]
    return some + [(800, t, "user", f"deep {t}") for t in range(40)] + [(805, t, "user", f"deep {t}") for t in range(39)]


def frame(spark, given):
    df = spark.createDataFrame(given, SCHEMA)
    wide = df.select("*", df.turn, df.turn, df.text, df.text)
    return wide.toDF(*df.columns, "path", "sizes", "TEXT", "shard")


@pytest.mark.parametrize("least", [1, 3, 40])
def test_nodes_by_all_prefixes(spark, least):
    own = prefix_trie.paths(frame(spark, rows()).repartition(3))
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(own), least=least)
    assert got.columns == COLUMNS
    assert Counter(map(tuple, got.collect())) == brute(rows())


def test_hot_conversation_lies_in_many_shards(spark):
    given = [(c, t, "user", f"same {t}") for c in range(0, 2000) for t in range(3)]
    own = prefix_trie.written(prefix_trie.rebuilt(prefix_trie.paths(frame(spark, given))), "t")
    cuts = prefix_trie.splitters(own, least=10)
    assert len(cuts) == 9 and len({p for p, _ in cuts}) == 1
    assert Counter(map(tuple, prefix_trie.prefix_trie(own, least=10).collect())) == brute(given)


def test_no_conversation_gives_no_node(spark):
    assert prefix_trie.conversation_trie(frame(spark, [])).collect() == []
    assert prefix_trie.conversation_trie(frame(spark, [(None, 1, "user", "x")])).collect() == []


def test_turnless_conversation_is_the_root(spark):
    lone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)    # its base is absent, its turn is replaced
    got = prefix_trie.conversation_trie(frame(spark, [(lone, 0, "user", "gone")])).collect()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{data.SMALL}/conversations.parquet')")
    want = con.sql(prefix_trie.ORACLE)
    assert want.columns == COLUMNS
    assert Counter(map(tuple, prefix_trie.op13_prefix_trie(spark, data.SMALL).collect())) == Counter(want.fetchall())
