"""Language identification of mixed texts: script ranges, word scores, Viterbi.

From a bounded sample of labelled texts (about ``SAMPLE`` documents a language,
all of a rarer one, drawn by a hash of the id) each language gets the log
frequencies of the character n-grams of its words (``GRAMS_KEPT`` most frequent
ones of each language), and the scripts that make up its letters. A word scores, for every
language that uses its script, the sum over its n-grams. Over the words of a
text, Viterbi finds the best sequence of languages when every change costs
``SWITCH``; its runs are the labelled spans. The text's language is the one
with most letters, its score that share of the letters.

Viterbi walks all texts of a batch at once, word by word, with numpy; words
are scored once a task (a bounded cache). Nothing is shuffled.

Defined cases: a null text or one without letters is ``und`` with score 0, as
is every text when nothing was learned; ties go to the first language in
alphabetical order; words without letters (or of a script that no language
has) count for no language; null and repeated ids keep their rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.llm.statistics import id_remainder
from zonecast.llm.storage import bound_batches, documents, picked, written
from zonecast.llm.wordhash import slices

SAMPLE = 1_500
FOLDS, HELD_OUT = 4, 2
GRAMS = (2, 3)
GRAMS_KEPT = 15_000
SWITCH = 15.0
SMOOTH = 0.5
SCRIPT_SHARE = 0.02
FOREIGN = -40.0
WORDS_KEPT = 300_000
UNKNOWN = "und"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\W\d_]+")

#: First code points of ranges, with the script that begins there (fixed values of the Unicode standard).
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x3040, "Kana"), (0x3100, "Other"), (0x3130, "Hangul"), (0x3190, "Other"), (0x31F0, "Kana"),
    (0x3200, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"),
    (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"),
]
_STARTS = [a for a, _ in SCRIPTS]


def script_of(letters: str) -> str:
    """The script of most letters."""
    if letters.isascii():
        return "Latin"
    return Counter(SCRIPTS[bisect_right(_STARTS, ord(c)) - 1][1] for c in letters).most_common(1)[0][0]


def grams_of(letters: str) -> list[str]:
    marked = f"<{letters}>"
    return [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """languages, their scripts, and the log frequency of each n-gram (rows; the last for unseen ones) by language."""
    languages: list[str]
    scripts: list[set[str]]
    grams: dict[str, int]
    logs: np.ndarray

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (words x languages) and letters of each word."""
        unseen, rows, ends, letters, low = len(self.grams), [], [], [], []
        for word in words:
            runs = LETTERS.findall(word.lower())
            got = "".join(runs)
            letters.append(len(got))
            before = len(rows)
            if got:
                script = script_of(got)
                fits = [script in s for s in self.scripts]
                if any(fits):
                    for run in runs:
                        rows.extend([self.grams.get(g, unseen) for g in grams_of(run)])
                    if not all(fits):
                        low.append((len(ends), [not f for f in fits]))
            ends.append(len(rows) - before)
        out = np.zeros((len(words), len(self.languages)))
        held = np.flatnonzero(ends)
        if len(held):
            starts = np.concatenate([[0], np.cumsum(ends)])[held]
            out[held] = np.add.reduceat(self.logs[rows], starts)
        for i, bad in low:
            out[i, bad] += FOREIGN
        return out, np.array(letters, np.int64)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of labelled documents (columns doc_id, text, lang), at most about ``sample`` of a language."""
    rows = picked(docs, "doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").count().collect()          # one row a language, as the model has
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], sample * 1_000_000 / r["count"])]) if sizes else None
    if share is not None:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) < share[F.col("lang")])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found: Counter = Counter()
            for text, lang in zip(frame["text"], frame["lang"], strict=True):
                for run, n in Counter(LETTERS.findall(text.lower())).items():
                    found[lang, "#" + script_of(run)] += n * len(run)
                    for g in grams_of(run):
                        found[lang, g] += n
            yield pd.DataFrame([(x, g, n) for (x, g), n in found.items()], columns=["lang", "gram", "n"])

    bound_batches(docs.sparkSession)
    counts = rows.select("text", "lang").mapInPandas(count, "lang string, gram string, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "grams")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    often = counts.where("gram NOT LIKE '#%'").select("gram", nth.alias("nth")).where(F.col("nth") <= GRAMS_KEPT)
    script = counts.where("gram LIKE '#%'").select("gram")
    wide = counts.join(often.select("gram").unionByName(script).distinct(), "gram")
    wide = wide.groupBy("gram").agg(*[F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{i}")
                                        for i, x in enumerate(languages)], F.count(F.lit(1)).alias("held")).orderBy("gram").collect()
    scripts = {r["gram"][1:]: r for r in wide if len(r["gram"]) > 1 and r["gram"][0] == "#"}
    kept = [r for r in wide if r["gram"][0] != "#"]
    total = [sum(r[f"n{i}"] for r in scripts.values()) for i in range(len(languages))]
    used = [{s for s, r in scripts.items() if r[f"n{i}"] > SCRIPT_SHARE * total[i]} for i in range(len(languages))]
    n = np.array([[r[f"n{i}"] for i in range(len(languages))] for r in kept] + [[0] * len(languages)], float)
    logs = np.log((n + SMOOTH) / (n + SMOOTH).sum(0, keepdims=True)) if languages else n
    return Model(languages, used, {r["gram"]: k for k, r in enumerate(kept)}, logs)


def viterbi(score: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best state of each row of ``score`` in the sequences first[t]:first[t + 1], a change costing ``switch``."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    starts, sizes = first[:-1][order], length[order]
    label = np.zeros(len(score), np.int64)
    if not len(score):
        return label
    stay = np.ones(score.shape, bool)
    top = np.zeros(len(score), np.int64)
    live = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")     # sequences longer than t
    value = score[starts[:live[0]]].copy()
    for t in range(1, sizes[0]):
        k = live[t]
        prior, at = value[:k], starts[:k] + t
        best = prior.argmax(1)
        moved = (prior[np.arange(k), best] - switch)[:, None]
        stay[at], top[at] = prior >= moved, best
        value[:k] = np.maximum(prior, moved) + score[at]
    state = value.argmax(1)
    for t in range(sizes[0] - 1, -1, -1):
        at = starts[:live[t]] + t
        now = state[:live[t]]
        label[at] = now
        state[:live[t]] = np.where(stay[at, now], now, top[at])
    return label


def identify(docs: DataFrame, model: Model, spans: bool = True, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score and (if wanted) spans: runs of words [start, end) with their language."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double"
    schema += ", spans array<struct<start:int,end:int,lang:string>>" if spans else ""
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, int] = {}
        scores, sizes = np.zeros((0, len(model.languages))), np.zeros(0, np.int64)
        for batch in batches:
            for rows in slices(batch, 1, 12 << 20):
                words = [WORD.findall(t or "") for t in rows.column(1).to_pylist()]
                first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
                flat = [x for w in words for x in w]
                if len(place) > WORDS_KEPT:
                    place, scores, sizes = {}, scores[:0], sizes[:0]
                if new := [x for x in dict.fromkeys(flat) if x not in place]:
                    got, letters = model.score(new)
                    place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
                    scores, sizes = np.concatenate([scores, got]), np.concatenate([sizes, letters])
                ids = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
                owner = np.repeat(np.arange(len(words)), np.diff(first))
                kinds = max(len(model.languages), 1)
                label = viterbi(scores[ids], first, switch) if model.languages else np.zeros(len(flat), np.int64)
                held = np.bincount(owner * kinds + label, sizes[ids], len(words) * kinds).reshape(-1, kinds)
                total, best = held.sum(1), held.argmax(1)
                known = (total > 0) & bool(model.languages)
                out = [rows.column(0), pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                       pa.array(np.where(known, held.max(1) / np.maximum(total, 1), 0.0))]
                if spans:
                    out.append(_spans(owner, label, sizes[ids] > 0, first, names))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "lang_pred", "score", "spans"][:len(out)])

    bound_batches(docs.sparkSession)
    return picked(docs, "doc_id", "text").mapInArrow(run, schema)


def _spans(owner, label, lettered, first, names) -> pa.Array:
    label = np.where(lettered, label, -1)
    seen = np.maximum.accumulate(np.where(lettered, np.arange(len(label)), -1))   # words without letters join a span
    same = (seen >= 0) & (seen >= first[owner])
    label = np.where(same, label[np.maximum(seen, 0)], len(names) - 1)
    begin = np.ones(len(label), bool)
    begin[1:] = (owner[1:] != owner[:-1]) | (label[1:] != label[:-1])
    at = np.flatnonzero(begin)
    stop = np.append(at[1:], len(label))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=len(first) - 1))])
    fields = [pa.array(at - first[owner[at]], pa.int32()), pa.array(stop - first[owner[at]], pa.int32()),
              pa.array(names[label[at]], pa.string())]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "end", "lang"]))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    model = learn(docs.where(~held))
    return identify(docs, model, spans=False).select("doc_id", held.alias("held_out"), "lang_pred", "score")
