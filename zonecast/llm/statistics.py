"""Statistics of a whole text as DataFrame expressions, and labelled samples of them."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.storage import picked, written
from zonecast.llm.text import whole, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: What the learners see: shares, so that long and short texts compare.
FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share",
            "distinct_share", "upper_share", "digit_share", "shout_share", "line_words")


def _without(text: str, chars: str) -> str:
    return f"char_length(translate({text}, '{chars}', ''))"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``value`` computed once and called ``name``.

    A column used inside a lambda may be copied into it and evaluated for
    every element; a lambda variable is not.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _repeat_words(w: str) -> str:
    """SQL for the words inside windows that are found twice or more.

    Windows of 8 words are compared by 64-bit hashes, made of the hashes of
    words, pairs and fours. Mostly all differ and nothing more is done; else
    the hashes are sorted with their places, and the union of the repeated
    windows is measured from place to place.
    """
    joined = lambda x, step: f"transform({x}, (v, i) -> xxhash64(v, get({x}, i + {step})))"
    near = "coalesce(get(s, j - 1).h = s[j].h, false) OR coalesce(get(s, j + 1).h = s[j].h, false)"
    union = f"""aggregate(transform(p, (x, k) -> least({WINDOW}, coalesce(get(p, k + 1) - x, {WINDOW}))),
        0L, (a, x) -> a + x)"""
    places = f"sort_array(transform(filter(sequence(0, size(s) - 1), j -> {near}), j -> s[j].i))"
    ranked = "sort_array(transform(h, (x, i) -> struct(x AS h, i AS i)))"
    counted = f"""CASE WHEN size(array_distinct(h)) = size(h) THEN 0L
        ELSE {_let('s', ranked, _let('p', places, union))} END"""
    hashes = _let("h1", f"transform({w}, x -> xxhash64(x))", _let("h2", joined("h1", 1), _let(
        "h4", joined("h2", 2), f"slice({joined('h4', 4)}, 1, size({w}) - {WINDOW - 1})")))
    return f"CASE WHEN size({w}) <= {WINDOW} THEN 0L ELSE {_let('h', hashes, counted)} END"


def with_statistics(df: DataFrame, text: Column) -> DataFrame:
    """``df`` (its columns must not start with ``_``) with the counts and the FEATURES of ``text``."""
    kept = df.columns
    df = df.withColumn("_t", whole(text)).withColumn("_w", words(F.col("_t")))
    df = df.withColumn("_l", F.expr(
        r"filter(split(_t, '\n'), x -> translate(x, ' \t\u000b\f\r', '') != '')".replace(
            r"\u000b", "\x0b").replace(r"\f", "\x0c")))
    marks = SYMBOLS + string.ascii_uppercase + string.digits + "!?"
    df = df.withColumn("_m", F.regexp_replace("_t", f"[^{marks}]+", ""))
    count = lambda chars: f"CAST(char_length(_m) - {_without('_m', chars)} AS BIGINT)"
    counts = {
        "n_words": "CAST(size(_w) AS BIGINT)",
        "word_chars": "CAST(char_length(array_join(_w, '')) AS BIGINT)",
        "n_symbols": count(SYMBOLS),
        "n_dup_lines": "CAST(size(_l) - size(array_distinct(_l)) AS BIGINT)",
        "n_repeat_words": _repeat_words("_w"),
        "_lines": "size(_l)",
        "_distinct": "size(array_distinct(_w))",
        "_upper": count(string.ascii_uppercase),
        "_digits": count(string.digits),
        "_shout": count("!?"),
    }
    df = df.select(*kept, *[F.expr(e).alias(k) for k, e in counts.items()])
    per = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1))
    return df.withColumns({
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "mean_word": per("word_chars", "n_words"),
        "symbol_share": per("n_symbols", "word_chars"),
        "dup_line_share": per("n_dup_lines", "_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "distinct_share": per("_distinct", "n_words"),
        "upper_share": per("_upper", "word_chars"),
        "digit_share": per("_digits", "word_chars"),
        "shout_share": per("_shout", "n_words"),
        "line_words": per("n_words", "_lines"),
    }).drop("_lines", "_distinct", "_upper", "_digits", "_shout")


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text (null: empty text) modulo ``mod``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def labelled_statistics(docs: DataFrame, labels: DataFrame, bound: int, where: Column | None = None) -> DataFrame:
    """FEATURES and quality of at most about ``bound`` labelled documents, written, in one partition.

    The documents are drawn by a hash of the id at a rate of bound / labels;
    only those (a list of bounded size, hence broadcast) have their statistics
    computed. ``where`` is a condition on ``doc_id``.
    """
    known = picked(labels, "doc_id", "quality").dropna()
    if where is not None:
        known = known.where(where)
    rate = min(1.0, bound / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < int(rate * 1_000_000))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = picked(docs, "doc_id", "text").join(F.broadcast(known), "doc_id")
    table = with_statistics(rows, F.col("text")).select("doc_id", "quality", *FEATURES)
    return written(table, "labelled").coalesce(1)
