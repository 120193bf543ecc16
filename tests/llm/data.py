"""Small documents with every awkward case, and plain versions of the contracts."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(letters) for _ in range(pick.randint(2, 7))) for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    pick, words = random.Random(seed), text.split(" ")
    for k in range(edits):
        words[pick.randrange(len(words))] = f"edit{seed}x{k}"
    return " ".join(words)


def rows() -> list[tuple]:
    base, passage = prose(1, 150), prose(2, 60)
    texts = [
        None, "", "   \n\t ", "one", "one two", "A b  C\td", "a b C d ", base, base, base.upper(), " " + base.replace(" ", "\n", 3),
        edited(base, 1, 1), edited(base, 2, 1), edited(base, 3, 4), edited(base, 4, 9), base + " tail",
        passage + " " + prose(3, 30), prose(4, 30) + " " + passage, prose(5, 10) + " " + passage + " " + passage,
        "w" * 120_000, prose(6, 9_000), prose(6, 9_000) + " end", "spam " * 400, "line one here\n" * 30,
        "Ünïcode ñandú 漢字 кириллица " * 12, "#$%& <a> |b| *** " * 20, "mail x.y@mail.example.com or +1 (262) 555-3752 now",
        "ip 66.160.61.22 and 999.1.1.1 card 4111 1111 1111 1111 and 4111-1111-1111-1112 end", "a" + chr(0xE000) + "b@c.de" + chr(0xE001),
        "<|endoftext|> is text here\x1cthere  twice \n", *[edited(base, 100 + k, 1 + k % 6) for k in range(40)],
    ]
    out = [(i, t, ("en", "de", None)[i % 3], ("src0", "src1", None)[i % 2 + (i % 7 == 0)], len(t or "")) for i, t in enumerate(texts)]
    n = len(out)
    out += [out[7], out[7], (8, "same id, other text", "en", "src0", 0), (None, base, "en", "src0", 0), (None, "no id", "fr", "src2", 0)]
    random.Random(0).shuffle(out)
    assert len(out) == n + 5
    return out


def docs(spark: SparkSession, given: list[tuple] | None = None, path=None) -> DataFrame:
    """The rows, beside columns whose names clash with everything."""
    df = spark.createDataFrame(rows() if given is None else given, SCHEMA)
    if path is not None:                    # rows are numbered by file position, as in production
        df.repartition(3, "n_chars").write.mode("overwrite").parquet(str(path))
        df = spark.read.parquet(str(path))
    clash = ["rid", "score", "n_words", "h", "key", "id", "kept", "_t", "p", "u", "seq", "text_key", "length"]
    wide = df.select("*", *[df.n_chars for _ in clash], df.text)
    return wide.toDF(*df.columns, *clash, "TEXT")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, size: int) -> frozenset:
    lower = {c: c + 32 for c in range(65, 91)}
    w = words((text or "").translate(lower))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def grouped(texts: list[str | None], size: int, a: int, b: int) -> list[int]:
    """Component (smallest place) of each text by all pairs; similar from a / b on."""
    sets = [shingles(t, size) for t in texts]
    part = list(range(len(texts)))

    def find(x: int) -> int:
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and b * len(x & y) >= a * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                part[hi] = lo
    return [find(i) for i in range(len(texts))]
