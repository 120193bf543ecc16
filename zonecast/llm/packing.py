"""Best-fit packing into sequences by minimum bin slack.

A document is its token ids and one closing id 0. Longer ones are cut into
pieces of ``ROOM`` ids, the first being the short one, so full pieces are
sequences of their own. Pieces of one length are alike, so packing needs only
the number of pieces of each length (at most ROOM counts, whatever the
corpus). On these counts the driver runs minimum bin slack: the longest piece
left, and for the room beside it the fullest feasible combination of lengths
by a subset-sum dynamic program over the bits of an integer; the combination
is used as often as its pieces last, then removed. The list of combinations
has at most a few entries a length.

Spark numbers the pieces of each length (per part of a hash, with the parts'
counts summed up, so a length with a third of all pieces is no hot group) and
looks up, in the broadcast list (bounded as said), the sequence and place of
each number.

Scale. Texts are read and tokenized once, in Arrow batches of bounded bytes;
what is written and shuffled is one narrow row a piece.

The vocabulary's added tokens (``<|endoftext|>``) are, with ``added``, one id
each where a text spells them, as ``tokenizers`` encodes by default; the text
between two of them is encoded by itself. The query and the pipeline's stage
do so. Without ``added`` they are ordinary text.

Defined cases: null and empty texts are one piece of one id; repeated rows and
ids are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.storage import bound_batches, documents, picked, written

ROOM = 2048
PARTS = 256
VOCABULARY = "byte_bpe_50k"
WORDS_KEPT = 800_000
#: White space besides a single space or line feed between visible characters.
APART = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
WIDE = ("\x85", "\xa0", "\u1680", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", *map(chr, range(0x2000, 0x200B)))
NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


@cache
def _tokenizer(vocabulary: str):
    """The byte-level BPE of ``<vocabulary>.tiktoken``: the ids of ``<vocabulary>.json``, encoded faster."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def _added(vocabulary: str) -> dict[str, int]:
    """The tokens that ``<vocabulary>.json`` adds to the merges, found in texts before any merge."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"added token {t['content']!r} of {vocabulary} is matched by more than its letters")
    return {t["content"]: t["id"] for t in tokens}


class Encoder(dict):
    """Ids of texts, as little-endian unsigned 32-bit bytes; the ids of a word are kept for its next use.

    A single space between two visible characters always begins a token, and a
    single line feed is one. So a text whose white space is only such spaces
    and line feeds is encoded word by word, a space or the line feed included.
    """

    def __init__(self, vocabulary: str, added: bool = False):
        super().__init__()
        self.encode = _tokenizer(vocabulary).encode_ordinary
        self.added = {k: np.array([i], "<u4").tobytes() for k, i in (_added(vocabulary) if added else {}).items()}
        self.cuts = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        ids = self[word] = self.plain(word if word[0] == "\n" else " " + word)
        return ids

    def ids(self, text: str) -> bytes:
        if any(x in text for x in self.added):
            return b"".join(self.added[x] if k % 2 else self.between(x) for k, x in enumerate(self.cuts.split(text)))
        return self.between(text)

    def between(self, text: str) -> bytes:
        if (not text or text[0] in " \n" or text[-1] in " \n" or any(x in text for x in APART)
                or not text.isascii() and any(x in text for x in WIDE)):
            return self.plain(text)
        words = text.replace("\n", " \n").split(" ")
        return self.plain(words[0]) + b"".join(map(self.__getitem__, words[1:]))

    def plain(self, text: str) -> bytes:
        return array("I", self.encode(text)).tobytes() if NATIVE else np.array(self.encode(text), "<u4").tobytes()


@cache
def _encoder(vocabulary: str, added: bool) -> Encoder:
    """One a worker process, for all its tasks."""
    return Encoder(vocabulary, added)


def pieces_of(docs: DataFrame, vocabulary: str = VOCABULARY, room: int = ROOM, added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, added)
        for batch in batches:
            rows, numbers = [], []
            for i, text in enumerate(batch.column(1)):
                ids = encoder.ids(text.as_py() or "") + b"\0\0\0\0"
                n = len(ids) // 4
                ends = [*range(n % room or room, n + 1, room)]
                for k, (a, b) in enumerate(zip([0, *ends], ends)):
                    rows.append(i)
                    numbers.append((k, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
            columns = list(zip(*numbers)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in columns[1:]]], names=schema.names)

    bound_batches(docs.sparkSession)
    return picked(docs, "doc_id", "text").mapInArrow(cut, schema)


def fullest(counts: list[int], room: int) -> list[tuple[int, int]]:
    """(length, times) of a combination of at most ``room`` in all, as full as any."""
    within, seen, reach = (1 << (room + 1)) - 1, [], 1
    for length in range(min(room, len(counts) - 1), 0, -1):
        left, step = min(counts[length], room // length), 1
        if left:
            seen.append((length, left, reach))
            while left:
                step = min(step, left)
                reach |= (reach << (length * step)) & within
                left, step = left - step, 2 * step
            if reach >> room & 1:
                break
    at, out = reach.bit_length() - 1, []
    for length, most, before in reversed(seen):
        times = next(t for t in range(most + 1) if at >= t * length and before >> (at - t * length) & 1)
        if times:
            out.append((length, times))
            at -= times * length
    return out


def minimum_bin_slack(counts: list[int], room: int = ROOM) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, times), ...]): combinations and how many sequences each fills."""
    counts, out = list(counts), []
    for longest in range(len(counts) - 1, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            mix = dict(fullest(counts, room - longest))
            counts[longest] += 1
            mix[longest] = mix.get(longest, 0) + 1
            bins = min(counts[x] // times for x, times in mix.items())
            for x, times in mix.items():
                counts[x] -= bins * times
            out.append((bins, sorted(mix.items(), reverse=True)))
    return out


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, room: int = ROOM, parts: int = PARTS,
         added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row a piece."""
    spark = docs.sparkSession
    pieces = pieces_of(docs, vocabulary, room, added).withColumn("rid", F.monotonically_increasing_id())
    pieces = written(pieces.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int")), "pieces")
    tally = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tally = written(tally.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "tally")
    counts = [0] * (room + 1)
    for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect():      # at most `room` rows
        counts[r["length"]] = r["n"]
    slots, sequence, used = [], 0, [0] * (room + 1)
    for bins, mix in minimum_bin_slack(counts, room):
        at = 0
        for length, times in mix:
            slots.append((length, used[length], times, sequence, at))
            used[length] += bins * times
            at += length * times
        sequence += bins
    table = spark.createDataFrame(slots, "length long, slot0 long, times long, sequence0 long, offset0 long")
    ends = Window.partitionBy("length").orderBy("slot0")
    table = table.withColumn("slot1", F.coalesce(F.lead("slot0").over(ends), F.lit(2 ** 62)))
    slot = F.struct("slot0", "slot1", "times", "sequence0", "offset0")
    table = table.groupBy("length").agg(F.sort_array(F.collect_list(slot)).alias("slots"))   # a few entries a length

    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "rid")
    ranked = pieces.withColumn("row", F.row_number().over(within)).join(
        tally.select("length", "part", "first"), ["length", "part"])        # dealt alike already
    ranked = ranked.withColumn("nth", F.col("first") + F.col("row") - 1).join(F.broadcast(table), "length")
    mine = F.get(F.filter("slots", lambda s: (s["slot0"] <= F.col("nth")) & (F.col("nth") < s["slot1"])), F.lit(0))
    placed = ranked.withColumn("slot", mine).withColumn("k", F.col("nth") - F.col("slot.slot0"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("slot.sequence0") + F.expr("k div slot.times")).alias("sequence_id"),
        (F.col("slot.offset0") + F.expr("k % slot.times") * F.col("length")).alias("offset"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), added=True)
