"""Substring deduplication by super-k-mers of words.

Every window of ``WINDOW`` words has a minimiser, the smallest hash among its
runs of ``GRAM`` words (the leftmost of equal ones). Consecutive windows that
share one at the same place form a super-k-mer. Equal windows have equal
minimisers at equal places in them, so a window that starts anywhere else
lies in another super-k-mer with the same minimiser: those whose minimiser
occurs once in the corpus are done. The others travel, each as one packed
string, to the bucket of their minimiser, where their windows are sorted and
counted exactly (equal hashes are confirmed by the bytes). Words covered by a
window found twice are removed.

Scale. A row of two numbers a super-k-mer is shuffled to find the repeated
minimisers; texts and packed strings move only for documents that have some.
Documents of equal word sequences are one sequence with a number of copies (a
sequence of at least WINDOW words with two copies is removed whole). Strings
of hot minimisers (at most sharedkeys.HOT_KEYS) don't meet in one bucket: of
equal ones in a slice of texts one travels, equal ones are counted by their
sha256 with partial aggregation, and only the windows of strings that occur
once are then counted singly.

Defined cases: null has no words; a text of fewer than WINDOW words is kept;
words stay unchanged and kept ones are joined by one space; repeated rows are
copies of each other.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.sharedkeys import repeated
from zonecast.llm.storage import bound_batches, documents, picked, written
from zonecast.llm.text import one_spaced
from zonecast.llm.wordhash import least, slices, windows, words_of

WINDOW = 35
GRAM = 14
FLUSH = 4 << 20


def super_kmers(texts: pa.Array, window: int, gram: int):
    """(text, first window, windows, minimiser) of each super-k-mer of the texts."""
    w = words_of(texts)
    n = len(w.hash) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    at, hash_ = windows(w, gram)
    grams = np.full(len(w.hash) - gram + 1, np.iinfo(np.uint64).max, np.uint64)
    grams[at] = hash_
    i = np.flatnonzero(w.text[:n] == w.text[window - 1:])
    if not len(i):
        return none, none, none, none
    place = least(grams, window - gram + 1)[i]
    begin = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (i[1:] != i[:-1] + 1)]))
    size = np.diff(np.append(begin, len(i)))
    owner = w.text[i[begin]]
    return owner, i[begin] - w.first[owner], size, grams[place[begin]].view(np.int64)


def _sequences(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """rid, doc_id, n_words, seq (sha256 of the words) and, once a task for each sequence, its super-k-mers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"rid long, doc_id {kind}, n_words long, seq binary, "
              "starts array<int>, sizes array<int>, minis array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for rows in slices(batch, 2):
                count, seq, fresh = [], [], np.zeros(rows.num_rows, bool)
                for k, text in enumerate(rows.column(2)):
                    words = (text.as_py() or "").encode().split()
                    count.append(len(words))
                    seq.append(hashlib.sha256(b" ".join(words)).digest())
                    if len(words) >= window and seq[-1] not in seen:
                        seen.add(seq[-1])
                        fresh[k] = True
                owner, start, size, mini = super_kmers(rows.column(2), window, gram)
                use = fresh[owner]
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[use], minlength=rows.num_rows))]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[use], t)) for x, t in
                         ((start, pa.int32()), (size, pa.int32()), (mini, pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(count, pa.int64()), pa.array(seq, pa.binary()), *lists],
                    names=["rid", "doc_id", "n_words", "seq", "starts", "sizes", "minis"])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return written(rows.mapInArrow(run, schema), "sequences")


def _pack(texts: DataFrame, window: int, hot: bool) -> DataFrame:
    """bucket, sid, start, packed: the super-k-mers in ``runs`` of each text, the hot or the others.

    Also last (start of the last window in it) and, of the hot ones, whether there are ``more``
    equal ones in the slice: one of these has the string, the others null.
    """
    schema = "bucket long, sid long, start int, packed binary, last int, more boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1):
                out: list[tuple] = []
                for sid, text, runs in zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True):
                    words = text.encode().split()
                    for r in runs:
                        a = r["start"]
                        out.append((r["mini"], sid, a, b" ".join(words[a:a + r["size"] + window - 1]), a + r["size"] - 1))
                columns = list(zip(*out, strict=True)) or [()] * 5
                more = [False] * len(out)
                if hot:
                    count, sent = Counter(columns[3]), set()
                    more = [count[s] > 1 for s in columns[3]]
                    columns[3] = [None if s in sent else sent.add(s) or s for s in columns[3]]
                kinds = pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.bool_()
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*columns, more], kinds, strict=True)],
                                                 names=["bucket", "sid", "start", "packed", "last", "more"])

    wanted = F.filter("runs", lambda r: r["hot"] if hot else ~r["hot"])
    return texts.select("sid", "text", wanted.alias("runs")).where(F.size("runs") > 0).mapInArrow(run, schema)


def _count_hot(packed: DataFrame, window: int) -> DataFrame:
    """sid, starts of repeated windows of hot super-k-mers, without a bucket.

    Equal strings are counted first, by their sha256: all windows of one that
    occurs twice repeat (those with equal ones in their slice are known). Of the others the windows are counted one by one,
    against those of one string of each kind.
    """
    rows = written(packed.withColumn("name", F.unhex(F.sha2("packed", 256))).select(
        "sid", "start", "name", "packed", "last", "more"), "hot")
    sent = rows.where("packed IS NOT NULL")
    names = written(sent.groupBy("name").agg(F.sum(F.when(F.col("more"), 2).otherwise(1)).alias("n"),
                                             F.min(F.struct("sid", "start")).alias("one")), "strings")
    single = sent.where("NOT more").join(names.where("n > 1").select("name"), "name", "left_semi")
    twice = rows.where("more").select("sid", "start", "last").unionByName(single.select("sid", "start", "last")).select(
        "sid", F.sequence("start", "last").alias("starts"))
    each = sent.join(names, "name").where((F.col("sid") == F.col("one.sid")) & (F.col("start") == F.col("one.start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                sid, start, single, window_ = [], [], [], []
                for s, a, n, string in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = string.split(b" ")
                    for k in range(len(words) - window + 1):
                        sid.append(s)
                        start.append(a + k)
                        single.append(n == 1)
                        window_.append(hashlib.sha256(b" ".join(words[k:k + window])).digest())
                yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(start, pa.int32()), pa.array(single),
                                                  pa.array(window_, pa.binary())], names=["sid", "start", "single", "w"])

    parts = written(each.select("sid", "start", "n", "packed").mapInArrow(run, "sid long, start int, single boolean, w binary"), "parts")
    common = parts.groupBy("w").agg(F.count("*").alias("n"), F.bool_or("single").alias("some")).where("n > 1 AND some")
    alone = parts.where("single").join(common.select("w"), "w", "left_semi")
    return twice.unionByName(alone.select("sid", F.array("start").alias("starts")))


def repeated_windows(packed: pa.Array, bucket: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, window in it) of the windows found twice or more in their bucket."""
    w = words_of(packed.cast(pa.string()))
    at, hash_ = windows(w, window)
    owner = w.text[at]
    order = np.lexsort((hash_, bucket[owner]))
    at, hash_, owner = at[order], hash_[order], owner[order]
    same = (hash_[1:] == hash_[:-1]) & (bucket[owner[1:]] == bucket[owner[:-1]])
    begin, end, data = w.begin[at], w.end[at + window - 1], w.data.tobytes()
    found = np.zeros(len(at), bool)
    heads = np.flatnonzero(np.concatenate([[True], ~same])) if len(at) else np.zeros(0, np.int64)
    head = np.repeat(heads, np.diff(np.append(heads, len(at))))
    for k in np.flatnonzero(head != np.arange(len(at))):        # equal hashes: the bytes decide
        for other in (head[k], k - 1):
            if data[begin[k]:end[k]] == data[begin[other]:end[other]]:
                found[k] = found[other] = True
                break
    return owner[found], at[found] - w.first[owner[found]]


def _count(packed: DataFrame, window: int) -> DataFrame:
    """sid, starts of repeated windows, from rows dealt and sorted by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            column = lambda k: rows.column(k).chunk(0) if rows.num_rows else pa.array([], rows.schema.field(k).type)
            sid, start = column(1).to_numpy(), column(2).to_numpy()
            owner, at = repeated_windows(column(3), column(0).to_numpy(), window)
            order = np.argsort(owner, kind="stable")
            owner, at = owner[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
            offsets = pa.array(np.append(first, len(owner)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(start[owner] + at, pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(sid[owner[first]], pa.int64()), lists], names=["sid", "starts"])

        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= FLUSH:
                rows = pa.Table.from_batches(held)
                bucket = rows.column(0).to_numpy()
                whole = int(np.searchsorted(bucket, bucket[-1]))   # the last bucket may go on
                if whole:
                    yield flush(rows.slice(0, whole))
                    held = rows.slice(whole).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    dealt = packed.select("bucket", "sid", "start", "packed").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "sid long, starts array<int>")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """sid, n_removed, kept_sha256, kept (text): words outside the windows at ``starts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1):
                removed, sha, left = [], [], []
                for text, starts in zip(rows.column(1).to_pylist(), rows.column(2), strict=True):
                    words = text.encode().split()
                    starts = starts.values.to_numpy()
                    edge = np.bincount(starts, minlength=len(words) + 1) - np.bincount(starts + window, minlength=len(words) + 1)
                    kept = b" ".join([x for x, c in zip(words, np.cumsum(edge), strict=False) if not c])
                    removed.append(int((np.cumsum(edge)[:len(words)] > 0).sum()))
                    sha.append(hashlib.sha256(kept).hexdigest())
                    left.append(kept)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                     pa.array(left, pa.binary()).cast(pa.string())], names=["sid", "n_removed", "kept_sha256", "kept"])

    return texts.mapInArrow(run, "sid long, n_removed long, kept_sha256 string, kept string")


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (text, null if unchanged): one row a document."""
    docs = picked(docs, "doc_id", "text")
    sequences = _sequences(docs, window, gram)
    copies = written(sequences.groupBy("seq").agg(F.count("*").alias("copies"), F.min("rid").alias("sid")), "copies")
    each = sequences.select("rid", F.explode(F.arrays_zip("starts", "sizes", "minis")).alias("k")).select(
        "rid", F.col("k.starts").alias("start"), F.col("k.sizes").alias("size"), F.col("k.minis").alias("mini"))
    runs = written(repeated(each, "mini", "rid"), "runs")
    names = sequences.join(copies.select(F.col("sid").alias("rid")), "rid", "left_semi").select(F.col("rid").alias("sid"), "seq")
    runs = runs.withColumnRenamed("rid", "sid").groupBy("sid").agg(
        F.collect_list(F.struct("start", "size", "mini", "hot")).alias("runs"))      # at most one a word of the text
    runs = written(names.join(runs, "sid"), "used")
    texts = docs.select(F.unhex(F.sha2(F.trim(one_spaced(F.col("text"))), 256)).alias("seq"), "text")
    texts = texts.join(runs.select("seq"), "seq", "left_semi").dropDuplicates(["seq"])
    texts = written(runs.join(texts, "seq").select("sid", "text", "runs"), "texts")

    cold = _count(_pack(texts, window, False), window)
    hot = _count_hot(_pack(texts, window, True), window)
    marks = written(cold.unionByName(hot), "marks").groupBy("sid").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    cut = written(_cut(texts.join(marks, "sid").select("sid", "text", "starts"), window), "cut")

    rows = sequences.select("doc_id", "n_words", "seq").join(copies, "seq").join(cut, "sid", "left")
    gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    return rows.select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("seq")))).alias("kept_sha256"),
        F.when(gone, F.lit("")).otherwise(F.col("kept")).alias("kept"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).drop("kept")
