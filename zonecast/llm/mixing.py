"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). Starting from the tokens
the cells have, weights are raked in turn until the tokens of each source,
language and topic have the target shares; each document is then sampled with
its cell's probability, weight / largest weight, by a hash of its id and text.
The largest weight is that of the cells with tokens: that is the largest sample
without repeats whose expected mixture is the fitted one.

Targets are shares by language and by topic (``OTHER`` takes what they don't
name; categories without tokens are left out and the rest scaled up), so these
two margins are bounded. Sources may be any number: their target is
tokens ** ``temper``, which evens them out (0: equal shares, 1: as they are).
A row of the cell table is a source with its tokens by language and topic, so
raking the sources is one expression a row and the other two margins one
global aggregation, partial in every task. Only languages x topics sums reach
the driver in a round. No row of documents is shuffled at all for it.

Defined cases: null language, source and text count as OTHER, the empty
source and the empty text; a text without words has no tokens but still a
probability; an empty table gives an empty result. Zero-mass margins are left
out. Repeated rows are kept or dropped together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.storage import column_of, documents, numbered, written
from zonecast.llm.text import SPACES, whole

OTHER = "other"
LANGUAGES = {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.15}
TOPICS = {"licence": 0.03, "contact": 0.03, "long": 0.2, "prose": 0.74}
TEMPER = 0.5
ROUNDS = 20
SEED = "mix-1"


def topic_of(text: Column, tokens: Column) -> Column:
    """A topic by simple marks of the text; callers may give their own column."""
    return (F.when(text.rlike("(?i)licen[cs]e"), "licence")
            .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("://")) | text.rlike(r"\+[0-9]"), "contact")
            .when(tokens >= 1500, "long").otherwise("prose"))


def uniform(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed, the id and the text alone."""
    label = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return F.conv(F.substring(F.md5(label), 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def fit_weights(cells: DataFrame, languages: dict[str, float], topics: dict[str, float],
                temper: float = TEMPER, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, weight) from (source, lang, topic, tokens)."""
    langs, kinds = [*languages, OTHER], [*topics, OTHER]
    pairs = [(x, k) for x in langs for k in kinds]
    held = lambda x, k: F.sum(F.when((F.col("lang") == x) & (F.col("topic") == k), F.col("tokens")))
    wide = cells.groupBy("source").agg(F.sum("tokens").alias("mass"), *[
        F.coalesce(held(*p), F.lit(0)).cast("double").alias(f"m{i}") for i, p in enumerate(pairs)])
    wide = written(wide.where("mass > 0").withColumn("goal", F.pow(F.col("mass").cast("double"), F.lit(temper))), "sources")
    seen = wide.agg(F.sum("goal").alias("goal"), *[F.sum(f"m{i}").alias(f"m{i}") for i in range(len(pairs))]).first()
    mass = {p: seen[f"m{i}"] or 0.0 for i, p in enumerate(pairs)}

    def goals(named: dict[str, float], values: list[str], axis: int) -> dict[str, float]:
        there = {v: named.get(v, 0.0) for v in values if sum(m for p, m in mass.items() if p[axis] == v) > 0}
        rest = max(0.0, 1 - sum(named.values()))
        if OTHER in there:
            there[OTHER] = max(rest, 1e-3)
        total = sum(there.values()) or 1.0
        return {v: there.get(v, 0.0) / total for v in values}

    to_lang, to_kind = goals(languages, langs, 0), goals(topics, kinds, 1)
    by_lang, by_kind = dict.fromkeys(langs, 1.0), dict.fromkeys(kinds, 1.0)
    factor = lambda: [F.lit(by_lang[x] * by_kind[k]) for x, k in pairs]
    raked = lambda: F.col("goal") / F.lit(float(seen["goal"] or 1.0)) / _sum(
        [F.col(f"m{i}") * f for i, f in enumerate(factor())])
    for _ in range(rounds):
        rows = wide.withColumn("a", raked())
        sums = rows.agg(*[F.sum(F.col("a") * F.col(f"m{i}")).alias(f"m{i}") for i in range(len(pairs))]).first()
        now = {p: sums[f"m{i}"] or 0.0 for i, p in enumerate(pairs)}
        for x in langs:
            if (s := sum(now[x, k] * by_kind[k] for k in kinds)) > 0:
                by_lang[x] = to_lang[x] / s
        for k in kinds:
            if (s := sum(now[x, k] * by_lang[x] for x in langs)) > 0:
                by_kind[k] = to_kind[k] / s
    for x in langs:                 # a margin without tokens has no weight
        by_lang[x] *= any(mass[x, k] > 0 for k in kinds)
    for k in kinds:
        by_kind[k] *= any(mass[x, k] > 0 for x in langs)
    cell = F.explode(F.array(*[F.struct(F.lit(x).alias("lang"), F.lit(k).alias("topic"), f.alias("f"))
                               for (x, k), f in zip(pairs, factor(), strict=True)]))
    return wide.withColumn("a", raked()).select("source", "a", cell.alias("c")).select(
        "source", "c.lang", "c.topic", (F.col("a") * F.col("c.f")).alias("weight"))


def _sum(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def with_probability(docs: DataFrame, languages: dict[str, float] | None = None,
                     topics: dict[str, float] | None = None, temper: float = TEMPER,
                     rounds: int = ROUNDS) -> DataFrame:
    """``numbered(docs)`` with source, lang, topic, tokens, p and u (sampled if u < p).

    p is 1 where the weight is largest among the cells that have tokens.
    """
    languages, topics = languages or LANGUAGES, topics or TOPICS
    lang, text = column_of(docs, "lang"), whole(column_of(docs, "text"))
    tokens = (F.size(F.split(text, SPACES)) - (text == "").cast("int") - text.rlike(r"^[\x20\x09-\x0D]").cast("int")
              - text.rlike(r"[\x20\x09-\x0D]\z").cast("int"))
    rows = numbered(docs).select(
        "*", F.coalesce(column_of(docs, "source").cast("string"), F.lit("")).alias("source"),
        F.when(lang.isin(*languages), lang).otherwise(F.lit(OTHER)).alias("lang"),
        F.greatest(tokens, F.lit(0)).cast("long").alias("tokens"),
        uniform(column_of(docs, "doc_id"), text).alias("u"))
    kind = topic_of(text, F.col("tokens"))
    rows = rows.withColumn("topic", F.when(kind.isin(*topics), kind).otherwise(F.lit(OTHER)))
    cells = written(rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "cells")
    weights = written(fit_weights(cells, languages, topics, temper, rounds), "weights")
    scale = weights.join(cells.where("tokens > 0"), ["source", "lang", "topic"], "left_semi")
    most = scale.agg(F.max("weight").alias("m")).first()["m"] or 1.0
    probability = weights.select("source", "lang", "topic", F.least(F.col("weight") / F.lit(most), F.lit(1.0)).alias("p"))
    out = rows.join(probability, ["source", "lang", "topic"], "left")
    return out.withColumn("p", F.coalesce("p", F.lit(0.0))).select(*rows.columns, "p")


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, with all their columns."""
    rows = with_probability(docs, **options)
    return rows.where(F.col("u") < F.col("p")).select(numbered(docs).columns).toDF(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return with_probability(docs).select(
        column_of(docs, "doc_id").alias("doc_id"), "source", "lang", "topic", "tokens",
        F.round("p", 6).alias("probability"), (F.col("u") < F.col("p")).alias("selected"))


def oracle_sql() -> str:
    """The same in DuckDB SQL: the rounds of the raking written out one after the other."""
    def case(column: str, named: dict[str, float], to: str) -> str:
        listed = ", ".join(f"('{k}', {v!r}e0)" for k, v in named.items())
        rest = max(max(0.0, 1 - sum(named.values())), 1e-3)
        return f"""{to}0 AS MATERIALIZED (SELECT t.k AS {column}, t.v FROM (VALUES {listed}, ('{OTHER}', {rest!r}e0)) t(k, v)
  WHERE t.k IN (SELECT {column} FROM cells WHERE tokens > 0)),
{to} AS MATERIALIZED (SELECT {column}, v / sum(v) OVER () AS goal FROM {to}0)"""

    space = r"[\x20\x09-\x0D]"
    ctes = [rf"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS t,
  CASE WHEN lang IN ({', '.join(f"'{x}'" for x in LANGUAGES)}) THEN lang ELSE '{OTHER}' END AS lang,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '{space}+'), lambda x: x <> '')) AS tokens FROM documents)""",
            rf"""rows AS MATERIALIZED (SELECT *, CASE WHEN regexp_matches(t, '(?i)licen[cs]e') THEN 'licence'
  WHEN contains(t, '@') OR contains(t, '://') OR regexp_matches(t, '\+[0-9]') THEN 'contact'
  WHEN tokens >= 1500 THEN 'long' ELSE 'prose' END AS topic,
  CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(t)), 1, 12) AS BIGINT) / {float(16 ** 12)!r}e0 AS u
  FROM d)""",
            "cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM rows GROUP BY ALL)",
            f"""sources AS MATERIALIZED (SELECT source, g / sum(g) OVER () AS goal FROM
  (SELECT source, pow(sum(tokens), {TEMPER!r}e0) AS g FROM cells GROUP BY source HAVING sum(tokens) > 0))""",
            case("lang", LANGUAGES, "langs"), case("topic", TOPICS, "topics"),
            "b0 AS (SELECT lang, goal, 1e0 AS b FROM langs)", "c0 AS (SELECT topic, goal, 1e0 AS c FROM topics)"]
    for i in range(ROUNDS + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT source, any_value(s.goal) / sum(x.tokens * b * c) AS a
  FROM cells x JOIN sources s USING (source) JOIN b{i} USING (lang) JOIN c{i} USING (topic) GROUP BY source)""")
        if i < ROUNDS:
            ctes.append(f"""b{i + 1} AS MATERIALIZED (SELECT lang, any_value(b{i}.goal) AS goal, any_value(b{i}.goal) / sum(x.tokens * a * c) AS b
  FROM cells x JOIN a{i} USING (source) JOIN b{i} USING (lang) JOIN c{i} USING (topic) GROUP BY lang)""")
            ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT topic, any_value(c{i}.goal) AS goal, any_value(c{i}.goal) / sum(x.tokens * a * b) AS c
  FROM cells x JOIN a{i} USING (source) JOIN b{i + 1} USING (lang) JOIN c{i} USING (topic) GROUP BY topic)""")
    ctes.append(f"""weights AS MATERIALIZED (SELECT source, lang, topic, a * b * c AS w
  FROM a{ROUNDS} CROSS JOIN b{ROUNDS} CROSS JOIN c{ROUNDS})""")
    ctes.append("""most AS MATERIALIZED (SELECT max(w) AS w FROM weights JOIN cells USING (source, lang, topic) WHERE cells.tokens > 0)""")
    return "WITH " + ",\n".join(ctes) + """
SELECT doc_id, r.source, r.lang, r.topic, r.tokens, round(least(coalesce(w / (SELECT w FROM most), 0e0), 1e0), 6) AS probability,
       u < least(coalesce(w / (SELECT w FROM most), 0e0), 1e0) AS selected
FROM rows r LEFT JOIN weights USING (source, lang, topic)"""
