"""Removal of repeated 100-byte strings, found in suffix arrays.

Texts are UTF-8 bytes. A byte goes if a ``WINDOW``-byte string that covers it
also starts earlier: in a document of a smaller id, or in the same one further
left. To bring equal strings together, each window has a minimiser, the
smallest hash of its runs of ``GRAM`` bytes; consecutive windows of one
minimiser are a piece, cut after PIECE windows. Equal windows have equal
minimisers, so windows of minimisers that occur once in the corpus are done.
The other pieces travel to the bucket of their minimiser. There equal pieces
are told by their sha256: all but the earliest are covered. The different
pieces of a bucket are laid end to end, their suffix array is built by linear
grouping (see ``suffix_array``), and windows that are equal lie next to each
other in it; each one's earliest start is known, and the others are covered.

Scale. A row of two longs a piece finds the repeated minimisers; texts move
for documents that have some, and again for those that are cut. Equal texts
are one text, that of the smallest id; a later copy is covered whole and needs
no join (the joins are by text and id, so that no group of copies meets).
Before pieces are shuffled each task keeps the earliest of equal ones and only
marks the others. A bucket whose pieces have more than HELD bytes, still have
more than PART when trimmed, or whose minimiser is hot (those are dealt to
SALTS parts), is sorted in parts: each gives the earliest start of its different windows, which are then compared
over the parts by their sha256, with partial aggregation. No bucket is
gathered beyond HELD, no batch beyond BATCH bytes, and nothing is dropped. Intervals of one text, at
most one for each of its bytes, meet in a row.

Defined cases: null is empty; a text shorter than a window stays whole; rows
of one id are one document (equal starts in two texts of one id cover
neither); a null id counts as smaller than all; repeated rows are treated
alike; columns are picked by position, others may have any names; an empty
table gives no rows; very long texts count whole, as one row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.sharedkeys import repeated
from zonecast.llm.storage import bound_batches, discard, documents, picked, written
from zonecast.llm.suffix_array import suffix_arrays
from zonecast.llm.text import whole
from zonecast.llm.wordhash import least, mix, slices

WINDOW = 100
GRAM = 24
PIECE = 2048            # windows
HELD = 1 << 20          # bytes of one bucket
PART = 16 << 10         # bytes of one suffix array
BATCH = 4 << 20         # bytes
SALTS = 64
NO_ID = -2 ** 63

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_BYTES = mix(np.arange(256, dtype=U), 11)
_BITS = 21
_PLACE = 1 << _BITS     # bytes of texts that are hashed at once, but for longer ones


def _laid(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings, end to end, and where each begins (one more: the end)."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def _power(n: int) -> np.uint64:
    return U(pow(int(_BASE), n, 2 ** 64))


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` bytes in a row: polynomials of 1, 2, 4, ... bytes, combined."""
    n = len(data) - size + 1
    part, span, taken, out = _BYTES.take(data), 1, 0, None
    while True:
        if size & span:
            piece = part[taken:taken + n]
            out = piece.copy() if out is None else out * _power(span) + piece
            taken += span
        if 2 * span > size:
            break
        part, span = part[:-span] * _power(span) + part[span:], 2 * span
    out ^= out >> U(32)
    out *= U(0xD6E8FEB86659FD93)
    return out


def _least(grams: np.ndarray, size: int) -> np.ndarray:
    """Place of the (leftmost) gram with the smallest leading bits of each ``size`` in a row."""
    if len(grams) > _PLACE:
        return least(grams >> U(_BITS), size)
    best = (grams & ~U(_PLACE - 1)) | np.arange(len(grams), dtype=U)       # the place lies in the bits behind
    span = 1
    while span < size:
        step = min(span, size - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    return best & U(_PLACE - 1)


def pieces(texts: pa.Array, window: int = WINDOW, gram: int = GRAM, most: int = PIECE):
    """(text, first window, windows, minimiser, place) of each piece, and the texts' bytes and begins.

    ``place`` is where the minimiser lies in the piece; -1 if it lies at
    several places of its run, so that windows of one run may be equal.
    """
    data, at = _laid(texts)
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none, none, none, data, at
    grams = _grams(data, gram)
    place = _least(grams, window - gram + 1)
    n = len(place)
    edge = np.append(True, place[1:] != place[:-1])
    edge[at[at < n]] = True
    begin = np.flatnonzero(edge)                              # of windows with one place, in one text
    owner = np.searchsorted(at, begin, "right") - 1
    last = np.minimum(np.append(begin[1:], n), at[owner + 1] - window + 1)
    inside = last > begin
    begin, last, owner, place = begin[inside], last[inside], owner[inside], place[begin[inside]].astype(np.int64)
    value = grams[place]
    heads = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))) if len(begin) else none
    places = np.diff(np.append(heads, len(begin)))
    place = np.where(places == 1, place[heads] - begin[heads], -1)
    last = last[heads + places - 1]
    begin, owner, value = begin[heads], owner[heads], value[heads]
    size = last - begin
    parts = -(-size // most)                                  # more than one only where the place is -1
    k = np.repeat(np.arange(len(begin)), parts)
    start = begin[k] + most * (np.arange(len(k)) - np.repeat(np.cumsum(parts) - parts, parts))
    return owner[k], start - at[owner[k]], np.minimum(most, last[k] - start), value[k].view(np.int64), place[k], data, at


def _scan(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """rid, did, doc_id, key (sha256 of the text), n_bytes and, once a task for each text, minis of its pieces."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for rows in slices(batch, 2, _PLACE):
                owner, _, _, mini, place, data, at = pieces(rows.column(2), window, gram)
                raw = data.tobytes()
                key = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                fresh = np.zeros(rows.num_rows, bool)
                for i in np.flatnonzero(np.diff(at) >= window).tolist():
                    if key[i] not in seen:
                        seen.add(key[i])
                        fresh[i] = True
                use = np.repeat(np.arange(len(mini)), 1 + (place < 0))     # twice: such a minimiser counts as repeated
                use = use[fresh[owner[use]]]
                offsets = pa.array(np.append(0, np.cumsum(np.bincount(owner[use], minlength=rows.num_rows))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(key, pa.binary()), pa.array(np.diff(at), pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(mini[use], pa.int64()))],
                    names=["rid", "doc_id", "key", "n_bytes", "minis"])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    out = rows.mapInArrow(run, f"rid long, doc_id {kind}, key binary, n_bytes long, minis array<long>")
    return written(out.withColumn("did", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))), "scanned")


SENT = "mini long, salt int, digest binary, piece binary, place int, did long, start int, tid long, begin int, stop int"


class _Sent:
    """Pieces and marks on their way to a batch; marks of one text that touch are one."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.marks: list[tuple[int, int, int]] = []

    def mark(self, tid: int, begin: int, stop: int) -> None:
        self.marks.append((tid, begin, stop))

    def merged(self) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        for tid, begin, stop in sorted(self.marks):
            if out and out[-1][0] == tid and out[-1][2] >= begin:
                if stop > out[-1][2]:
                    out[-1] = (tid, out[-1][1], stop)
            else:
                out.append((tid, begin, stop))
        self.marks = []
        return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(f, kinds[k]) for f, k in (part.strip().split(" ") for part in fields.split(","))])


def _send(texts: DataFrame, window: int, gram: int, salts: int) -> DataFrame:
    """SENT: the earliest of equal pieces of a task's texts (2 MB at a time), and marks over the others."""
    schema = _arrow(SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2, _PLACE):
                owner, start, size, mini, place, data, at = pieces(rows.column(2), window, gram)
                wanted = np.zeros(len(owner), bool)
                hot = np.zeros(len(owner), bool)
                edge = np.searchsorted(owner, np.arange(rows.num_rows + 1))
                for i in range(rows.num_rows):
                    own = slice(edge[i], edge[i + 1])
                    cold_, hot_ = (rows.column(c)[i].values.to_numpy() for c in (3, 4))
                    hot[own] = np.isin(mini[own], hot_)
                    wanted[own] = hot[own] | np.isin(mini[own], cold_)
                raw, out, found = data.tobytes(), _Sent(), {}
                tid, did = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                use = np.flatnonzero(wanted)
                for i, a, n, m, some, split in zip(owner[use].tolist(), start[use].tolist(), size[use].tolist(), mini[use].tolist(),
                                                   place[use].tolist(), hot[use].tolist(), strict=True):
                    piece = raw[at[i] + a:at[i] + a + n + window - 1]
                    digest = hashlib.sha256(piece).digest()[:16]
                    best = found.setdefault((m, digest), [])
                    if best and (did[i], a) > best[0][5:7]:
                        out.mark(tid[i], a, a + len(piece))
                        continue
                    if best and (did[i], a) < best[0][5:7]:
                        for row in best:
                            out.mark(row[7], row[6], row[6] + len(piece))
                        best.clear()
                    best.append((m, int.from_bytes(digest[:4], "little") % salts if split else -1, digest, piece, some, did[i], a, tid[i], None, None))
                yield _batch([row for best in found.values() for row in best], schema)
                yield _batch([(None,) * 7 + mark for mark in out.merged()], schema)

    return texts.mapInArrow(run, SENT)


FOUND = "tid long, begin int, stop int, did long, window binary"


def _alike(a: bytes, b: bytes) -> int:
    """Bytes that two strings have in common at their start."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:                                                    # a[:low] equal, a[:high] not
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def trimmed(group: list[tuple], window: int) -> list[tuple]:
    """Pieces of one whole bucket, less what can't lie in a window of two of them.

    An equal window has the minimiser at an equal place, so it reaches no
    further to each side of it than the piece has in common with any other.
    """
    if len(group) < 2 or any(p[4] < 0 for p in group):                      # a minimiser at several places
        return group
    reach = []
    for side in ([p[0][:p[4]][::-1] for p in group], [p[0][p[4]:] for p in group]):
        order = sorted(range(len(group)), key=side.__getitem__)
        most = [0] * len(group)
        for i, j in zip(order, order[1:], strict=False):
            n = _alike(side[i], side[j])
            most[i], most[j] = max(most[i], n), max(most[j], n)
        reach.append(most)
    return [(p[0][p[4] - left:p[4] + right], p[1], p[2] + p[4] - left, p[3], left)
            for p, left, right in zip(group, *reach, strict=True) if left + right >= window]


class _Bucket:
    """Different pieces, to be laid end to end: sorted once enough of them wait."""

    def __init__(self, window: int, out: _Sent) -> None:
        self.window, self.out = window, out
        self.texts: list[list[tuple]] = []           # each: (piece, did, start, tid, place), to be one text of the suffix arrays
        self.partial: list[bool] = []
        self.bytes = 0

    def add(self, group: list[tuple], partial: bool) -> None:
        self.texts.append(group)
        self.partial.append(partial)
        self.bytes += sum(len(p[0]) + 1 for p in group)

    def sort(self) -> Iterator[tuple]:
        """Marks the covered windows; yields the earliest of the different windows of partial texts."""
        length = np.array([sum(len(p[0]) + 1 for p in g) for g in self.texts])
        band = np.log2(np.maximum(length, 1)).astype(int) // 2             # texts of about equal length run in step
        for b in np.unique(band):
            which = np.flatnonzero(band == b)
            yield from self._sort([self.texts[i] for i in which], np.array([self.partial[i] for i in which]), length[which])
        self.texts, self.partial, self.bytes = [], [], 0

    def _sort(self, texts: list[list[tuple]], partial: np.ndarray, length: np.ndarray) -> Iterator[tuple]:
        window = self.window
        all_ = [p for g in texts for p in g]
        size = np.array([len(p[0]) for p in all_])
        data = np.frombuffer(b"\0".join([p[0] for p in all_]) + b"\0", np.uint8)
        first = np.cumsum(size + 1) - size - 1
        symbols = data.astype(np.int32) + 2
        symbols[first + size] = 1                                            # between pieces
        order = suffix_arrays(symbols, length)
        piece = np.repeat(np.arange(len(all_)), size + 1)[order]
        fits = order + window <= (first + size)[piece]
        order, piece = order[fits], piece[fits]
        text = np.repeat(np.arange(len(texts)), [len(g) for g in texts])[piece]
        view = np.lib.stride_tricks.sliding_window_view(data, window)
        same = np.zeros(len(order), bool)                                    # as the window before it
        for a in range(1, len(order), 1 << 14):
            b = min(a + (1 << 14), len(order))
            same[a:b] = (text[a:b] == text[a - 1:b - 1]) & (view[order[a:b]] == view[order[a - 1:b - 1]]).all(1)
        did = np.array([p[1] for p in all_])[piece]
        start = np.array([p[2] for p in all_])[piece] + order - first[piece]
        kind = np.cumsum(~same) - 1
        by = np.lexsort((start, did, kind))
        lead = by[np.flatnonzero(~same)] if len(by) else by                  # the earliest of each kind
        covered = (did != did[lead][kind]) | (start != start[lead][kind])
        at = np.sort(order[covered])
        if len(at):
            runs = np.flatnonzero(np.append(True, np.diff(at) != 1))
            stops = np.append(at[runs[1:] - 1], at[-1]) + window
            where = np.searchsorted(first, at[runs], "right") - 1
            for p, a, b in zip(where.tolist(), (at[runs] - first[where]).tolist(), (stops - first[where]).tolist(), strict=True):
                self.out.mark(all_[p][3], all_[p][2] + a, all_[p][2] + b)
        if partial.any():
            raw = data.tobytes()
            for i in np.flatnonzero(partial[text] & ~covered).tolist():
                a = int(order[i])
                yield (all_[piece[i]][3], int(start[i]), None, int(did[i]), hashlib.sha256(raw[a:a + window]).digest()[:16])


def _buckets(sent: DataFrame, window: int, part: int, batch_bytes: int) -> DataFrame:
    """FOUND: marks (begin, stop), and windows of parts (begin, did, window) to be compared over all parts."""
    schema = _arrow(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Sent()
        bucket = _Bucket(window, out)
        key = digest = least_ = None                                          # of the row before
        group: list[tuple] = []
        held, parts = 0, False

        def leave(end: bool) -> None:                                        # the bucket at hand is at its end, or full
            nonlocal group, held, parts
            if end and not parts:
                group = trimmed(group, window)
            parts |= not end
            many = any(p[4] < 0 for p in group)
            texts, size = [[]], 0
            for p in group:
                if size and size + len(p[0]) > part:
                    texts.append([])
                    size = 0
                texts[-1].append(p)
                size += len(p[0])
            for text in texts if len(group) > 1 or parts or many else []:
                if text:
                    bucket.add(text, parts or len(texts) > 1)
            group, held = [], 0

        def ready() -> Iterator[pa.RecordBatch]:
            windows = list(bucket.sort())
            yield _batch(windows, schema)
            yield _batch([(t, a, b, None, None) for t, a, b in out.merged()], schema)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(8)]
            for mini, salt, name, piece, place, did, start, tid in zip(*columns, strict=True):
                if (mini, salt) != key:
                    leave(True)
                    key, digest, parts = (mini, salt), None, salt >= 0
                if name == digest and (did, start) > least_:
                    out.mark(tid, start, start + len(piece))
                    continue
                if name != digest:
                    digest, least_ = name, (did, start)
                if held and held + len(piece) > HELD:
                    leave(False)
                group.append((piece, did, start, tid, place))
                held += len(piece)
                if bucket.bytes >= batch_bytes:
                    yield from ready()
        leave(True)
        yield from ready()

    names = ["mini", "salt", "digest", "piece", "place", "did", "start", "tid"]
    dealt = sent.where("mini IS NOT NULL").select(*names).repartition("mini", "salt").sortWithinPartitions(
        "mini", "salt", "digest", "did", "start")
    return dealt.mapInArrow(run, FOUND)


def _cut(texts: DataFrame) -> DataFrame:
    """key, did, n_removed, spans, kept_sha256, kept of texts whose marks are given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2):
                removed, spans, sha, kept = [], [], [], []
                for text, marks in zip(rows.column(2).cast(pa.binary()).to_pylist(), rows.column(3).to_pylist(), strict=True):
                    gone: list[dict] = []
                    for m in sorted(marks, key=lambda m: m["begin"]):
                        if gone and m["begin"] <= gone[-1]["stop"]:
                            gone[-1]["stop"] = max(gone[-1]["stop"], m["stop"])
                        else:
                            gone.append(dict(m))
                    edges = [0, *[x for g in gone for x in (g["begin"], g["stop"])], len(text)]
                    left = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
                    removed.append(len(text) - len(left))
                    spans.append(gone)
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left)
                span = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(sha, pa.string()),
                     pa.array(kept, pa.binary())], names=["key", "did", "n_removed", "spans", "kept_sha256", "kept"])

    return texts.mapInArrow(run, "key binary, did long, n_removed long, spans array<struct<begin:int,stop:int>>, "
                                 "kept_sha256 string, kept binary")


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, part: int = PART, batch_bytes: int = BATCH,
                 salts: int = SALTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (of bytes), kept (binary, null if unchanged): one row a document."""
    docs = picked(docs, "doc_id", "text")
    bound_batches(docs.sparkSession)
    scanned = _scan(docs, window, gram)
    rows = written(scanned.drop("minis", "rid"), "rows")
    first = written(scanned.groupBy("key").agg(F.min("did").alias("did"), F.min("rid").alias("tid")), "first")
    minis = written(scanned.where(F.size("minis") > 0).select("rid", "minis").join(
        first.select(F.col("tid").alias("rid")), "rid", "left_semi").select("rid", F.explode("minis").alias("mini")), "minis")
    discard(scanned)
    again = written(repeated(minis, "mini", "rid").groupBy(F.col("rid").alias("tid")).agg(
        *[F.collect_set(F.when(is_, F.col("mini"))).alias(c) for c, is_ in (("cold", ~F.col("hot")), ("hot", F.col("hot")))]), "again")
    discard(minis)
    wanted = again.join(first, "tid")
    whole_ = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"), whole(F.col("text")).alias("text"))
    texts = whole_.withColumn("key", F.unhex(F.sha2("text", 256))).join(wanted, ["key", "did"]).dropDuplicates(["key", "did"])
    texts = written(texts.select("tid", "did", "text", "cold", "hot", "key"), "texts")
    sent = written(_send(texts, window, gram, salts), "sent")
    found = written(_buckets(sent, window, part, batch_bytes), "found")
    parts = found.where("window IS NOT NULL").select("tid", "begin", F.struct("did", "begin").alias("at"), "window")
    earliest = parts.groupBy("window").agg(F.min("at").alias("least"), F.max("at").alias("most")).where("least <> most")
    over = parts.join(earliest.select("window", "least"), "window").where("at > least").select(
        "tid", "begin", (F.col("begin") + window).cast("int").alias("stop"))
    marks = sent.where("mini IS NULL").select("tid", "begin", "stop").unionByName(
        found.where("window IS NULL").select("tid", "begin", "stop")).unionByName(over)
    marks = marks.groupBy("tid").agg(F.collect_list(F.struct("begin", "stop")).alias("marks"))
    cut = _cut(texts.select("tid", "key", "did", "text").join(marks, "tid").select("key", "did", "text", "marks"))
    cut = written(cut, "cut")
    discard(again, texts, sent, found)
    cut = first.select("key", "did").join(cut, ["key", "did"], "left").withColumn("here", F.lit(True))
    rows = rows.join(cut, ["key", "did"], "left")
    gone = F.col("here").isNull() & (F.col("n_bytes") >= window)              # a later copy of an equal text
    return rows.select(
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce(F.size("spans"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("key")))).alias("kept_sha256"),
        F.when(gone, F.array(F.struct(F.lit(0).alias("begin"), F.col("n_bytes").cast("int").alias("stop")))).otherwise(
            F.coalesce("spans", F.array().cast("array<struct<begin:int,stop:int>>"))).alias("spans"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).drop("spans", "kept")


#: Windows by md5; ids of ``documents`` are unique and not null here.
ORACLE = f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
windows AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, {2 * WINDOW})) AS w
  FROM (SELECT doc_id, h, unnest(range(n - {WINDOW - 1})) AS s FROM texts)),
earliest AS (SELECT w, min((doc_id, s)) AS one FROM windows GROUP BY w HAVING count(*) > 1),
covered AS (SELECT doc_id, s FROM windows JOIN earliest USING (w) WHERE (doc_id, s) > one),
heads AS (SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > {WINDOW}, true) AS head FROM covered),
runs AS (SELECT doc_id, s, sum(head::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM heads),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + {WINDOW} AS b FROM runs GROUP BY doc_id, run),
before AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans),
cuts AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS stop,
         string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS kept
  FROM before JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * stop + 1), h))) AS kept_sha256
FROM texts LEFT JOIN cuts USING (doc_id)
"""
