"""Packing documents into training sequences by best-fit decreasing.

Documents are tokenized in the tasks that read them and cut there: overlong ones first give full windows,
the rest is one piece. Only the pieces' lengths travel on. They are dealt by hash over buckets of a fixed
expected size; inside a bucket a segment tree indexed by remaining capacity finds the tightest open
sequence for each piece, longest first. Whatever the size of the input, a bucket leaves a handful of
sequences open, so padding stays a small constant share.

Words are tokenized once per task and kept in a table of bounded size: the tokenizer drops white space and
never joins across it, so the ids of a text are its words' ids in order.

Defined cases: NULL and empty texts give the end id alone; repeated rows are packed as rows of their own;
equal lengths go by document id, then start, then checksum; an empty table gives no sequences; other columns
of the input are ignored, so their names cannot clash. The bucket of a piece depends on its content alone,
so a task that is run again after a lost executor makes the same pieces for the same buckets.
"""

from __future__ import annotations

import os
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import text_batches

CAPACITY = 4096
END_ID = 2
#: Documents per bucket: a few ten thousand numbers in memory.
BUCKET_DOCS = 8192
#: Bytes of text that count as one document where the ids travel too: 32 MB per bucket.
TEXT_BYTES = 4096
#: Words a worker remembers before it starts anew.
REMEMBER = 400_000

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Marks that the tokenizer splits from a letter before them; those of its special tokens are not among them.
MARKS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"
#: Letters whose lower case depends on the library or the place.
_UNEVEN = frozenset("\u0130\u03a3")
#: Byte-level models show a byte as the character of its number if printable, all others as those from 256 on, in order.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class WordTable:
    """Token ids of words as little-endian bytes, filled from the tokenizer in batches of unknown words.

    A word and the marks after it are tokenized apart, ASCII words in lower case, as the tokenizer itself does; so the
    forms of a word cost one call. What was used since the last but one filling stays.
    """

    def __init__(self, path: str, remember: int = REMEMBER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.remember = Tokenizer.from_file(path), remember
        self.model = Tokenizer(self.tokenizer.model)
        self.known: dict[str, bytes] = {"": b""}
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            self._learn([w for w in dict.fromkeys(words) if w not in self.known])
            out = b"".join(map(self.known.__getitem__, words))
        if len(self.known) > self.remember:
            self.known = {"": b""}
        if len(self.young) > self.remember:
            self.young, self.old = {"": b""}, self.young
        return out

    def _learn(self, new: list[str]) -> None:
        split = []
        for w in new:
            core = w.rstrip(MARKS)
            if not core or core is w or not core[-1].isalpha():
                core = w
            split.append((w, core.lower() if core.isascii() and "<" not in core else core, w[len(core):]))
        young, old = self.young, self.old
        unknown = []
        for part in dict.fromkeys(p for _, core, tail in split for p in (core, tail)):
            if part not in young:
                if part in old:
                    young[part] = old[part]
                else:
                    unknown.append(part)
        # Of words of letters alone only their bytes matter to the model, so these skip the text rules before it.
        plain = [p for p in unknown if p.isalpha() and (p.isascii() or (unicodedata.is_normalized("NFC", p) and not _UNEVEN.intersection(p)))]
        other = list(set(unknown).difference(plain))
        shown = [p if p.isascii() else p.lower().encode().decode("latin-1").translate(_SHOWN) for p in plain]
        for parts, tokenizer, given in ((plain, self.model, shown), (other, self.tokenizer, other)):
            for part, coded in zip(parts, tokenizer.encode_batch_fast(given, add_special_tokens=False), strict=True):
                young[part] = np.asarray(coded.ids, "<u4").tobytes()
        for w, core, tail in split:
            self.known[w] = young[core] + young[tail]


_tables: dict[str, WordTable] = {}


def _table(path: str) -> WordTable:
    """One table per tokenizer and worker process."""
    if path not in _tables:
        _tables[path] = WordTable(path)
    return _tables[path]


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Cut every document's ids into windows of ``capacity`` and a rest: one row per piece (:data:`PIECE`).

    ``with_ids`` adds the ids themselves as little-endian unsigned 32-bit bytes.
    """
    end = np.asarray([end_id], "<u4").tobytes()
    schema = PIECE + (", ids binary" if with_ids else "")

    def cut(batches):
        table = _table(tokenizer)
        for batch in batches:
            rows = []
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = table.ids(whole or "") + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    row = (doc, start, len(part) // 4, zlib.crc32(part), n)
                    rows.append((*row, part) if with_ids else row)
            columns = list(zip(*rows, strict=True)) or [[]] * (5 + with_ids)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.binary()) for c in columns[5:]],
                                  names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; the lengths come in descending order.

    A segment tree over the remaining capacities 0..capacity holds in each node whether any open sequence
    below it has that much room. The tightest fit is the first marked leaf at or right of the length.
    """
    leaves = 1 << capacity.bit_length()
    marked = bytearray(2 * leaves)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, length in enumerate(lengths.tolist()):
        node = leaves + length
        while node and not marked[node]:  # on to the next subtree at the right
            while node & 1:
                node >>= 1
            node += node > 0
        if not node:
            room, k, made = capacity, made, made + 1
        else:
            while node < leaves:  # descend to the leftmost marked leaf
                node = 2 * node if marked[2 * node] else 2 * node + 1
            room = node - leaves
            k = open_at[room].pop()
            if not open_at[room]:
                _set(marked, node, 0)
        sequence[i], offset[i] = k, capacity - room
        if left := room - length:
            if not open_at[left]:
                _set(marked, leaves + left, 1)
            open_at[left].append(k)
    return sequence, offset


def _set(marked: bytearray, node: int, value: int) -> None:
    marked[node] = value
    while node > 1:
        node >>= 1
        marked[node] = marked[2 * node] | marked[2 * node + 1]


def pack(cut: DataFrame, n_docs: int, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece its sequence and offset. ``n_docs`` only sets the number of buckets."""
    buckets = max(1, -(-n_docs // BUCKET_DOCS))
    kept = [c for c in cut.columns if c != "ids"]
    schema = PACKED + (", ids binary" if "ids" in cut.columns else "")

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        sequence, offset = best_fit(rows["length"].to_numpy(), capacity)
        rows["sequence_id"], rows["offset"] = (int(rows["_bucket"].iloc[0]) << 32) + sequence, offset
        return rows[[c.split()[0] for c in schema.split(", ")]]

    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))
    return cut.select(*kept, *(["ids"] if "ids" in cut.columns else []), bucket.alias("_bucket")).groupBy("_bucket").applyInPandas(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of packed pieces that carry their ids: sequence_id, n_tokens, ids (array of at most ``capacity``)."""
    parts = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    hexed = F.hex(F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])))
    swap = "conv(concat({}), 16, 10)".format(", ".join(f"substr(h, 8 * i + {k}, 2)" for k in (7, 5, 3, 1)))
    return parts.withColumn("h", hexed).select(
        "sequence_id", "n_tokens", F.expr(f"transform(sequence(0, cast(n_tokens as int) - 1), i -> cast({swap} as int))").alias("ids"))


def run(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Cut and pack whole documents; ``with_ids`` keeps the ids of every piece.

    Pieces with ids are dealt by bytes too, so that a bucket of long texts holds no more than one of many short ones.
    """
    text_batches(docs.sparkSession)
    cut = pieces(docs, tokenizer, with_ids=with_ids)
    if not with_ids:
        return pack(cut, docs.count())
    n_docs, n_bytes = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return pack(cut, max(n_docs, -(-n_bytes // TEXT_BYTES)))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every piece of every document with its place."""
    import public_tokenizers

    return run(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
