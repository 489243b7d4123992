"""Suffix-array dedup: remove every byte that a long enough repeated string covers, wherever its copies are.

A string of ``WINDOW`` bytes is a repeat if it starts at two places of the corpus. The windows of a text are cut
into stretches under content-defined keys (``anchors``); equal windows have equal keys, so only stretches whose
key occurs twice can hold repeats, and only these travel, each with the bytes its windows span. Stretches with
the same bytes collapse to one with a count before they meet. Buckets of keys then build a run-length
index (``run_index``) over their distinct stretches and follow its matching statistics from the run ends; a match
of at least ``WINDOW`` bytes marks both its places. Marks go back to the texts by joins.

What is broadcast are two bitmaps of fixed size (16 MB and 2 MB): a false hit makes a stretch travel for nothing.
Copies of a text are told by its digest; texts with copies are removed whole without being spelled out. A key with
more than ``CROWD`` distinct stretches is not indexed in one place: its windows are counted by hash instead,
which combines before the shuffle.

Defined cases: NULL text is the empty one; texts shorter than the window keep all; repeated rows remove each other;
rows with equal or NULL ids are told apart by their text; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import WINDOW, gram_hashes, stretches
from tidemark.llm.run_index import RunIndex, covered
from tidemark.llm.text import whole
from tidemark.session import staged, text_batches

KEY_BITS, TEXT_BITS = 27, 24
CROWD = 20_000
#: Stretches per bucket, about 4 MB of text.
BUCKET = 12_000
#: Texts and stretches that a task remembers to leave out repeats of.
REMEMBER = 1_000_000


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()


def _bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of ``2 ** bits`` cells, marked by the low bits of a long column; put together on the executors by block."""
    cell = F.pmod(F.col(column), F.lit(1 << bits))
    blocks = df.select(F.bitmap_bucket_number(cell).alias("block"), F.bitmap_bit_position(cell).alias("bit")).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("m"))
    size = 1 << 15  # bits in a block
    out = np.zeros(((1 << bits) // size + 2, size // 8), np.uint8)
    for block, m in zip(*[c.to_pylist() for c in blocks.toArrow().columns], strict=True):
        out[block] = np.frombuffer(m, np.uint8)
    return out.reshape(-1)


def _marked(bitmap: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    cell = values & np.int64((1 << bits) - 1)
    block, bit = np.where(cell > 0, 1 + (cell - 1) // 32768, 0), np.where(cell > 0, (cell - 1) % 32768, 0)
    return (bitmap[block * 4096 + bit // 8] >> (bit % 8).astype(np.uint8)) & 1 == 1


def key_counts(docs: DataFrame, text: str) -> DataFrame:
    """How often each stretch key occurs, summed per batch in the task and over all by Spark."""
    def read(batches):
        for batch in batches:
            found = [stretches(np.frombuffer(_raw(t), np.uint8)) for t in batch.column(0).to_pylist()]
            every = np.concatenate([k for k, *_ in found]) if found else np.empty(0, np.int64)
            keys, at = np.unique(every, return_inverse=True)
            twice = np.concatenate([r for *_, r in found]) if found else np.empty(0, bool)
            count = np.bincount(at, 1 + twice, len(keys)).astype(np.int64)  # one that recurs in its stretch counts as two
            yield pa.record_batch([pa.array(keys), pa.array(count)], names=["key", "count"])

    return docs.select(text).mapInArrow(read, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))


def occurrences(docs: DataFrame, text: str, keys) -> DataFrame:
    """Every stretch with a marked key: key, its bytes' digest, where it starts; the bytes once per task."""
    def read(batches):
        seen: set[bytes] = set()
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                raw = _raw(t)
                if len(raw) < WINDOW:
                    continue
                tid = _digest(raw)
                if tid in seen:
                    continue
                if len(seen) > REMEMBER:
                    seen.clear()
                seen.add(tid)
                key, first, last, _ = stretches(np.frombuffer(raw, np.uint8))
                hit = np.flatnonzero(_marked(keys.value, key, KEY_BITS))
                for k, a, b in zip(key[hit].tolist(), first[hit].tolist(), last[hit].tolist(), strict=True):
                    out.append((k, raw[a:b + WINDOW], tid, a))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.record_batch([pa.array(c, x) for c, x in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.int64()), strict=True)],
                                  names=["key", "bytes", "tid", "at"])

    return docs.select(text).mapInArrow(read, "key long, bytes binary, tid binary, at long")


def _index(rows: pd.DataFrame, window: int = WINDOW) -> pd.DataFrame:
    """Marked intervals of each distinct stretch of a bucket."""
    rows = rows.sort_values(["key", "sid"], ignore_index=True)
    several = rows["count"].to_numpy() > 1
    alone = ~rows["key"].duplicated(keep=False).to_numpy()
    marks: dict[int, list] = {int(i): [(0, len(rows["bytes"].iloc[i]))] for i in np.flatnonzero(several)}
    shown = np.flatnonzero(~alone)  # a key's only stretch can match nothing but its own copies and itself
    inside = np.flatnonzero(alone & ~several & (rows["bytes"].str.len().to_numpy() > window))
    chosen = np.union1d(shown, inside)
    if len(chosen):
        index = RunIndex(rows["bytes"].iloc[chosen].tolist(), window)
        owner, start, length = index.matches()
        order = np.argsort(owner, kind="stable")
        owner, start, end = owner[order], start[order], (start + length)[order]
        for i, part in zip(*np.unique(owner, return_index=True), strict=True):
            to = np.searchsorted(owner, i, "right")
            row = int(chosen[i])
            if row not in marks:
                marks[row] = covered(start[part:to], end[part:to])
    at = sorted(marks)
    return pd.DataFrame({"key": rows["key"].iloc[at].to_numpy(), "sid": rows["sid"].iloc[at].to_numpy(),
                         "marks": [[{"start": a, "end": b} for a, b in marks[i]] for i in at]})


MARKS = "array<struct<start:long,end:long>>"


def _windows(stretch: DataFrame) -> DataFrame:
    """key, sid, at and two hashes of every window of crowded keys' stretches."""
    def read(batches):
        for batch in batches:
            for key, sid, raw, count in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = np.frombuffer(raw, np.uint8)
                h = gram_hashes(data, WINDOW)
                g = gram_hashes(data[::-1], WINDOW)[::-1]
                n = len(h)
                yield pa.record_batch([pa.array([key] * n, pa.int64()), pa.array([sid] * n, pa.binary()), pa.array(np.arange(n)), pa.array(h.astype(np.int64)),
                                       pa.array(g.astype(np.int64)), pa.array([count] * n, pa.int64())], names=["key", "sid", "at", "h", "g", "count"])

    return stretch.select("key", "sid", "bytes", "count").mapInArrow(read, "key long, sid binary, at long, h long, g long, count long")


def repeated_spans(docs: DataFrame, text: str = "text", crowd: int = CROWD) -> DataFrame:
    """tid (digest of a text) and its removed spans, for texts that hold repeats; texts with copies are left to the caller."""
    spark = text_batches(docs.sparkSession)
    counts = staged(key_counts(docs, text).filter("count > 1"))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    keys = spark.sparkContext.broadcast(_bitmap(counts, "key", KEY_BITS))  # 16 MB at most
    found = staged(occurrences(docs, text, keys).withColumn("sid", F.unhex(F.md5("bytes"))))
    keys.destroy()
    stretch = found.groupBy("key", "bytes").agg(F.count("*").alias("count")).withColumn("sid", F.unhex(F.md5("bytes")))
    # Keys with too many distinct stretches for one place; the digest only names a stretch within its key.
    crowded = found.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > crowd).select("key")
    is_crowded = not (crowded := staged(crowded)).isEmpty()
    buckets = max(1, -(-int(total[0]) // BUCKET))
    plain = stretch.join(crowded, "key", "left_anti") if is_crowded else stretch
    marks = plain.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket").applyInPandas(
        lambda rows: _index(rows), f"key long, sid binary, marks {MARKS}")
    if is_crowded:
        each = _windows(stretch.join(crowded, "key", "left_semi"))
        twice = each.groupBy("h", "g").agg(F.sum("count").alias("n")).filter("n > 1").select("h", "g")
        spots = each.join(twice, ["h", "g"]).groupBy("key", "sid").agg(
            F.collect_list(F.struct(F.col("at").alias("start"), (F.col("at") + WINDOW).alias("end"))).alias("marks"))  # a stretch's own windows
        marks = marks.unionByName(spots)
    placed = found.select("key", "sid", "tid", "at").join(staged(marks), ["key", "sid"]).select("tid", F.expr(
        "transform(marks, m -> named_struct('start', m.start + at, 'end', m.end + at))").alias("spans"))
    merged = placed.groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # the spans of one text

    def union(batches):
        for batch in batches:
            spans = [covered(np.array([s["start"] for s in x], np.int64), np.array([s["end"] for s in x], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([[{"start": a, "end": b} for a, b in s] for s in spans],
                                                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["tid", "spans"])

    return merged.mapInArrow(union, f"tid binary, spans {MARKS}")


def _cut(raw: bytes, spans) -> bytes:
    out, at = [], 0
    for s in spans:
        out.append(raw[at:s["start"]])
        at = s["end"]
    return b"".join([*out, raw[at:]])


def _texts(docs: DataFrame, text: str, wanted) -> DataFrame:
    """tid and text of the texts whose bit is marked, each once per task."""
    def read(batches):
        seen: set[bytes] = set()
        for batch in batches:
            tid, out = [], []
            for t in batch.column(0).to_pylist():
                raw = _raw(t)
                d = _digest(raw)
                if len(raw) >= WINDOW and d not in seen and _marked(wanted.value, np.array([int.from_bytes(d[:7])]), TEXT_BITS)[0]:
                    if len(seen) > REMEMBER:
                        seen.clear()
                    seen.add(d)
                    tid.append(d)
                    out.append(raw)
            yield pa.record_batch([pa.array(tid, pa.binary()), pa.array(out, pa.binary())], names=["tid", "raw"])

    return docs.select(text).mapInArrow(read, "tid binary, raw binary")


def with_spans(docs: DataFrame, text: str = "text", crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Spans to remove by text digest (of texts without copies), and the digests of the texts that have copies."""
    tid = docs.select(F.unhex(F.sha2(whole(F.col(text)).cast("binary"), 256)).alias("tid"), F.octet_length(whole(F.col(text))).cast("long").alias("n_bytes"))
    copies = staged(tid.filter(F.col("n_bytes") >= WINDOW).groupBy("tid", "n_bytes").agg(F.count("*").alias("n")).filter("n > 1"))
    return staged(repeated_spans(docs, text, crowd).join(copies.select("tid"), "tid", "left_anti")), copies


def report(docs: DataFrame, text: str = "text", key: str = "doc_id", crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    spans, copies = with_spans(docs, text, crowd)
    low = spans.select(F.conv(F.hex(F.substring("tid", 1, 7)), 16, 10).cast("long").alias("low"))
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(low, "low", TEXT_BITS))  # 2 MB

    def cut(batches):
        for batch in batches:
            tid, raw, marks = (c.to_pylist() for c in batch.columns)
            left = [_cut(r, s) for r, s in zip(raw, marks, strict=True)]
            yield pa.record_batch([pa.array(tid, pa.binary()), pa.array([len(r) - len(x) for r, x in zip(raw, left, strict=True)], pa.int64()),
                                   pa.array([len(s) for s in marks], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())],
                                  names=["tid", "n_removed", "n_spans", "kept_sha256"])

    # Texts meet their spans once per task that holds them; the rows then only exchange digests.
    cuts = _texts(docs, text, wanted).join(spans, "tid").select("tid", "raw", "spans").mapInArrow(
        cut, "tid binary, n_removed long, n_spans long, kept_sha256 string").dropDuplicates(["tid"])
    gone = copies.select("tid", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"))
    changed = staged(cuts.unionByName(gone))
    rows = docs.select(F.col(key).alias("doc_id"), F.sha2(whole(F.col(text)).cast("binary"), 256).alias("sha"), F.octet_length(whole(F.col(text))).cast("long").alias("n_bytes"))
    return rows.withColumn("tid", F.unhex("sha")).join(changed, "tid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def remove(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents less their repeats, with all their columns; those of which nothing is left are dropped.

    A character goes if any of its bytes does, so texts stay valid. Untouched texts, empty ones too, stay as they are.
    """
    spans, copies = with_spans(docs, text)
    known = spans.unionByName(copies.select("tid", F.expr(f"cast(array(named_struct('start', 0L, 'end', n_bytes)) as {MARKS})").alias("spans")))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), whole(F.col(f"`{text}`")).alias("_t"))
    inner = inner.withColumn("tid", F.unhex(F.sha2(F.col("_t").cast("binary"), 256))).drop("_t").join(staged(known), "tid", "left")

    @F.pandas_udf("string")
    def left(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(_raw(t), s).decode("utf-8", "ignore") for t, s in zip(texts, spans, strict=True)])

    same = F.col("spans").isNull()
    value = F.col("_row").getField(text)
    touched = inner.filter(~same).withColumn("_left", left(value, F.col("spans"))).filter(F.col("_left") != "")
    return inner.filter(same).select("_row").unionByName(touched.select(F.col("_row").withField(f"`{text}`", F.col("_left")).alias("_row"))).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: what repeats take from every document."""
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
