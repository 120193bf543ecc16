"""Personal data by seed patterns and bootstrapped contextual extraction.

Seeds are the matches of fixed expressions (e-mail, IP, card, phone) in the
whole text. The tokens before a seed are its lexical patterns: the last one,
two and three of them, if one holds a letter (tokens are words; the marks
``MARKS`` stand for themselves). Runs of identifier characters with a digit or
an inner mark, and groups of digits with blanks and brackets, are candidates.
Seeds and candidates form a graph of patterns and instances, which Spark
scores in rounds until no instance is added:

  pattern, kind:  confidence = its occurrences before known instances of the
                  kind / its occurrences in the whole corpus; accepted from
                  MIN_KNOWN different known instances and MIN_CONFIDENCE on
  instance:       belongs to the kind whose accepted patterns it has, with
                  1 - product(1 - confidence); from MIN_CONFIDENCE on, and if
                  all its kinds of characters occur in seeds of that kind, it
                  is known in the next round

and candidates that stand in an accepted pattern and are known are reported
as spans of that kind, beside the seeds. Where no pattern leads to seeds more
often than to other text, there is nothing to accept and the seeds are all.

Scale. A narrow row a document (its seeds and candidates with their contexts)
is written; the rounds aggregate and join rows of the graph by pattern and by
instance, with partial aggregation. Texts are read once more in a round with
new patterns: their n-grams are tested against a Bloom filter of fixed size of
those patterns, so that few are counted. Expressions are possessive or
anchored to the start of a run, so that their time is linear in long texts.

Defined cases: a null text is empty; an empty table gives an empty one; no
spans give the hash and the string of an empty list; positions are code
points, end exclusive; repeated rows are separate rows; ties between kinds go
to the first in alphabetical order; other columns may have any names; texts of
any length are used whole, but a pattern lies within CONTEXT characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.storage import documents, picked, written
from zonecast.llm.text import whole
from zonecast.operators.membership import bloom_filter, may_contain

KINDS = ("email", "ip", "card", "phone")
MIN_KNOWN = 3
MIN_CONFIDENCE = 0.6
MARKS = r"[:=#\"\x27(\[]"
CONTEXT = 128

OPEN, CLOSE, PLAIN = "\ue000", "\ue001", "\ue002"      # private use: marks around matches; PLAIN for either in a text

_LOCAL = "[A-Za-z0-9._%+-]"
_ID = "[A-Za-z0-9_.@+/-]"
#: Equal to the plain forms, but without backtracking: a match can only begin where a run or the last match ends.
EXPRESSIONS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "other": rf"(?<!{_ID})(?:[(+]*[0-9](?:[\x20().0-9/-]*[0-9])?(?!{_ID})|"
             rf"(?=[A-Za-z]*+(?:[0-9]|[_.@+/-]++[A-Za-z0-9])){_ID}{{3,}}+)",
}
#: What a text must hold for a match; cheap to test.
NEEDS = {"email": "contains(t, '@')", "ip": r"t RLIKE r'[0-9]\.[0-9]'", "card": "t RLIKE r'[0-9][ -]?[0-9]'",
         "phone": r"t RLIKE r'\+[0-9]'", "other": "t RLIKE r'[0-9]|[A-Za-z][_.@+/-]+[A-Za-z]'"}
_DIGITS = r"regexp_replace(m.v, '[^0-9]', '')"
_LUHN = """aggregate(transform(sequence(1, char_length(d)), i -> CAST(substr(reverse(d), i, 1) AS INT) * (2 - i % 2)),
    0, (a, x) -> a + x - IF(x > 9, 9, 0)) % 10 = 0"""
_HOLDS = {
    "email": "true",
    "ip": r"forall(split(m.v, '\\.'), x -> coalesce(try_cast(x AS INT), 256) <= 255)",
    "card": f"get(transform(array({_DIGITS}), d -> char_length(d) BETWEEN 13 AND 19 AND {_LUHN}), 0)",
    "phone": f"char_length({_DIGITS}) BETWEEN 9 AND 15",
    "other": "true",
}
_MATCH = "struct<s:int,e:int,v:string,c:string>"


def _matches(kind: str) -> str:
    """SQL for the matches of a kind in column t: start, end, value and the text before it.

    Matches are marked in the text, which is split at the marks; lengths of
    the parts add up to the places.
    """
    parts = f"split(regexp_replace(t, r'{EXPRESSIONS[kind]}', '{OPEN}$0{CLOSE}'), '{OPEN}')"
    value = f"substring_index(p, '{CLOSE}', 1)"
    step = f"""named_struct('first', false, 'at', a.at + char_length(p) - IF(a.first, 0, 1),
        'c', right(concat(a.c, replace(p, '{CLOSE}', '')), {CONTEXT}),
        'out', IF(a.first, a.out, concat(a.out, array(named_struct(
            's', a.at, 'e', a.at + char_length({value}), 'v', {value}, 'c', a.c)))))"""
    start = f"named_struct('first', true, 'at', 0, 'c', '', 'out', CAST(array() AS array<{_MATCH}>))"
    found = f"filter(aggregate({parts}, {start}, (a, p) -> {step}, a -> a.out), m -> {_HOLDS[kind]})"
    return f"CASE WHEN {NEEDS[kind]} THEN {found} ELSE CAST(array() AS array<{_MATCH}>) END"


def find_seeds(docs: DataFrame) -> DataFrame:
    """rid, doc_id, one array of matches a kind, and other (candidates apart from them); written."""
    text = F.translate(whole(F.col("text")), OPEN + CLOSE, PLAIN + PLAIN)
    rows = picked(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("rid"), "doc_id", text.alias("t"))
    rows = written(rows.select("rid", "doc_id", *[F.expr(_matches(k)).alias(k) for k in EXPRESSIONS]), "seeds")
    seeds = f"concat({', '.join(KINDS)})"
    return rows.withColumn("other", F.expr(
        f"CASE WHEN size(other) = 0 THEN other ELSE "
        f"filter(other, o -> NOT exists({seeds}, b -> b.s < o.e AND o.s < b.e)) END"))


def _tokens(text: str) -> str:
    """SQL for the lower-case tokens of a text."""
    return rf"array_remove(split(regexp_replace(lower({text}), r'{MARKS}', ' $0 '), r'\s+'), '')"


def _graph(seeds: DataFrame) -> DataFrame:
    """rid, kind ('other': candidate), s, e, value, patterns: one row an occurrence that has patterns.

    A context that ends within a word has none; of one cut to CONTEXT the first token is left out.
    """
    each = [seeds.where(F.size(k) > 0).select("rid", F.lit(k).alias("kind"), F.explode(k).alias("m")) for k in EXPRESSIONS]
    rows = each[0]
    for more in each[1:]:
        rows = rows.unionByName(more)
    rows = rows.where(rf"m.c RLIKE r'(\s|{MARKS})\z'").withColumn("w", F.expr(_tokens("m.c")))
    rows = rows.withColumn("w", F.expr(f"IF(char_length(m.c) >= {CONTEXT}, slice(w, 2, size(w)), w)"))
    joined = "transform(sequence(1, 3), n -> IF(size(w) >= n, array_join(slice(w, -n, n), ' '), ''))"
    rows = rows.select("rid", "kind", "m.s", "m.e", F.lower("m.v").alias("value"), F.expr(
        rf"filter({joined}, p -> p RLIKE '\\p{{L}}')").alias("patterns"))
    return rows.where(F.size("patterns") > 0)


def _in_corpus(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern, all: how often each of ``patterns`` occurs in all texts."""
    rows = picked(docs, "text").select(F.expr(_tokens("coalesce(CAST(text AS STRING), '')")).alias("w")).where(F.size("w") > 0)
    one, two = "w[i]", "concat(w[i], ' ', get(w, i + 1))"
    grams = f"flatten(transform(sequence(0, size(w) - 1), i -> array({one}, {two}, concat({two}, ' ', get(w, i + 2)))))"
    grams = rows.select(F.explode(F.expr(grams)).alias("pattern")).withColumn("_bits", bloom_filter(patterns, "pattern").scalar())
    counts = grams.where(may_contain(F.col("_bits"), F.col("pattern"))).groupBy("pattern").agg(F.count(F.lit(1)).alias("all"))
    return counts.join(patterns, "pattern", "left_semi")


def _kinds_of_characters(value: str) -> str:
    """SQL: letters as a, digits as 0, any other character as itself."""
    return rf"array_distinct(split(regexp_replace(regexp_replace({value}, '\\p{{L}}', 'a'), '[0-9]', '0'), ''))"


def discover(seeds: DataFrame, docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """rid, kind, s, e: candidates that accepted patterns and known instances agree on."""
    graph = written(_graph(seeds), "graph")
    edges = graph.select("kind", "value", F.explode("patterns").alias("pattern"))
    edges = written(edges.groupBy("kind", "value", "pattern").agg(F.count(F.lit(1)).alias("n")), "edges")
    known = written(edges.where("kind <> 'other'").select("value", "kind").distinct(), "known")
    pairs = written(edges.groupBy("value", "pattern").agg(F.sum("n").alias("n")), "pairs")
    looks = known.select("kind", F.explode(F.expr(_kinds_of_characters("value"))).alias("c"))
    looks = looks.groupBy("kind").agg(F.collect_set("c").alias("seen"))
    sizes: DataFrame | None = None
    size, turn = known.count(), 0
    while True:
        hits = pairs.join(known, "value").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("known"), F.sum("n").alias("before"))
        hits = written(hits.where(F.col("known") >= MIN_KNOWN), f"hits{turn}")
        new = hits.select("pattern").distinct()
        if sizes is not None:
            new = new.join(sizes, "pattern", "left_anti")
        counted = _in_corpus(docs, written(new, f"new{turn}"))
        sizes = written(counted if sizes is None else sizes.unionByName(counted), f"sizes{turn}")
        accepted = hits.join(sizes, "pattern").withColumn("confidence", F.least(F.col("before") / F.col("all"), F.lit(1.0)))
        accepted = written(accepted.where(F.col("confidence") >= MIN_CONFIDENCE).select("pattern", "kind", "confidence"), f"patterns{turn}")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        scored = pairs.join(accepted, "pattern").groupBy("value", "kind").agg((1 - doubt).alias("confidence"))
        scored = scored.where(F.col("confidence") >= MIN_CONFIDENCE).join(looks, "kind").where(
            f"size(array_except({_kinds_of_characters('value')}, seen)) = 0").select("value", "kind")
        grown = written(known.unionByName(scored).distinct(), f"known{turn}")
        known, before, turn = grown, size, turn + 1
        size = known.count()
        if size == before or turn == rounds:
            break
    found = graph.where("kind = 'other'").select("rid", "s", "e", "value", F.explode("patterns").alias("pattern"))
    found = found.join(accepted.select("pattern", "kind"), "pattern").join(known, ["value", "kind"])
    return found.groupBy("rid", "s", "e").agg(F.min("kind").alias("kind"))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_sha256 and spans: one row a document."""
    seeds = find_seeds(docs)
    added = discover(seeds, docs).groupBy("rid").agg(F.collect_list(F.struct("kind", "s", "e")).alias("added"))
    rows = seeds.drop("other").join(added, "rid", "left")
    base = [f"transform({k}, m -> concat('{k}:', m.s, ':', m.e))" for k in KINDS]
    more = [f"transform(sort_array(concat(transform({k}, m -> struct(m.s AS s, m.e AS e)), transform(filter(coalesce(added, "
            f"array()), a -> a.kind = '{k}'), a -> struct(a.s AS s, a.e AS e)))), m -> concat('{k}:', m.s, ':', m.e))" for k in KINDS]
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.expr(f"array_join(concat({', '.join(base)}), ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join(concat({', '.join(more)}), ',')").alias("spans"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))
