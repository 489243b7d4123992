"""Exact Jaccard join of documents on word shingles, filtered under several global token orders.

Two sets whose similarity reaches the limit share a token among the rarest few of each (a prefix), whatever
total order of tokens "rarest" follows. One order leaves false candidates; several orders that break ties
and estimate rarity differently leave few, since a pair has to pass all of them before it is verified.

Rarity comes from two fixed-size sketches that count every shingle of every document (a cell per hash, like a
count-min sketch): any estimate gives a valid order, and frequent shingles land behind whatever the corpus
size, so prefixes of boilerplate and large families do not meet in hot keys. The sketches are all that is
broadcast, 8 MB at any scale, with a bitmap of the same kind.

Steps: (1) sets with the same content collapse to their signature; (2) prefixes under each order are dealt by
token; (3) tokens of up to ``DENSE`` sets give pairs, which must also share prefix tokens under the other orders;
tokens of more sets are searched in blocks and give a forest of edges, never all pairs. Either way a pair needs close
histograms of token hashes: ``SLOTS`` small counts per set bound the number of tokens that differ from below, which
turns away sets that share no more than a passage; (4) connected candidates form
families; every member's set travels to its family once and is compared there exactly, in blocks of ``BLOCK`` sets,
larger families as pairs of blocks, so no task holds more than two blocks; (5) verified links are connected.

Defined cases: NULL, empty and blank texts have no shingles and stand alone; fewer words than a shingle make one
shingle; repeated rows and equal ids count as one node; NULL ids are nodes of their own (``component_id``
NULL); an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shingles import mix, shingle_set
from tidemark.session import staged, text_batches

CELLS = 1 << 19
SKETCHES = 2
ORDERS = 3
DENSE = 16
BLOCK = 512
#: Sets per block of a dense token; these carry histograms only.
WIDE = 4096
SLOTS = 64
#: Cells of the bitmap that tells which signatures have candidates.
MARKS = 1 << 22


def _cells(h: np.ndarray) -> np.ndarray:
    """The cell of each hash in each sketch, as one numbering."""
    out = np.empty(SKETCHES * len(h), np.int64)
    for k in range(SKETCHES):
        out[k * len(h):(k + 1) * len(h)] = ((h >> np.uint64(7 + 20 * k)) & np.uint64(CELLS - 1)) + np.uint64(k * CELLS)
    return out


def _signature(tokens: np.ndarray, scattered: np.ndarray | None = None) -> int:
    """One 64-bit number for a whole set, from its tokens' hashes and these mixed again (if already at hand)."""
    scattered = mix(tokens) if scattered is None else scattered
    both = np.array([scattered.sum(dtype=np.uint64), np.bitwise_xor.reduce(scattered, initial=0)], np.uint64)
    return int(mix(mix(both[:1] + np.uint64(len(tokens))) + both[1:]).astype(np.int64)[0])


def scan(docs: DataFrame, text: str, key: str, size: int) -> DataFrame:
    """One pass over the texts: a row per document (doc, sig, n, slots), and per task its counts of sketch cells (cell, count)."""
    def read(batches):
        counts = np.zeros(CELLS * SKETCHES, np.int64)
        for batch in batches:
            sig, n, slots, cells, waiting = [], [], [], [], 0
            for t in batch.column(1).to_pylist():
                tokens = shingle_set(t, size)
                scattered = mix(tokens)
                cells.append(_cells(tokens))
                waiting += len(tokens)
                if waiting > 1 << 18:  # counted together, since every count passes over all cells
                    counts += np.bincount(np.concatenate(cells), minlength=len(counts))
                    cells, waiting = [], 0
                sig.append(_signature(tokens, scattered))
                n.append(len(tokens))
                slots.append(np.minimum(np.bincount((scattered & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS), 255).astype(np.uint8).tobytes())
            if waiting:
                counts += np.bincount(np.concatenate(cells), minlength=len(counts))
            none = pa.nulls(len(n), pa.int64())
            yield pa.record_batch([batch.column(0), pa.array(sig, pa.int64()), pa.array(n, pa.int64()), pa.array(slots, pa.binary()), none, none], names=names)
        for at in range(0, len(counts), CELLS // 4):
            part = counts[at:at + CELLS // 4]
            found = np.flatnonzero(part)
            none = pa.nulls(len(found), pa.int64())
            yield pa.record_batch([none, none, none, pa.nulls(len(found), pa.binary()), pa.array(found + at), pa.array(part[found])], names=names)

    names = ["doc", "sig", "n", "slots", "cell", "count"]
    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(read, "doc long, sig long, n long, slots binary, cell long, count long")


def _sketches(rows: DataFrame) -> np.ndarray:
    """The summed sketches; a fixed number of cells."""
    found = rows.filter("cell is not null").groupBy(F.col("cell").cast("int").alias("cell")).agg(
        F.least(F.sum("count"), F.lit(2 ** 31 - 1)).cast("int").alias("count")).toArrow()
    counts = np.zeros(CELLS * SKETCHES, np.int32)
    counts[found.column("cell").to_numpy()] = found.column("count").to_numpy()
    return counts


def prefixes(docs: DataFrame, text: str, counts, size: int, percent: int) -> DataFrame:
    """Prefix tokens of every distinct set under every order: token, order, sig, n, and whether the shorter prefix has it."""
    def read(batches):
        seen: set[int] = set()
        sketch = counts.value
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                tokens = shingle_set(t, size)
                first = mix(tokens)
                n, sig = len(tokens), _signature(tokens, first)
                if not n or sig in seen:
                    continue
                if len(seen) > 2_000_000:
                    seen.clear()  # only repeats work, which the join drops
                seen.add(sig)
                long = n - -(-percent * n // 100) + 1
                short = n - -(-2 * percent * n // (100 + percent)) + 1
                both = sketch[_cells(tokens)].reshape(SKETCHES, n).astype(np.uint64)
                for order in range(ORDERS):
                    rare = both[order] if order < SKETCHES else both.min(0)
                    scattered = mix(tokens + np.uint64(order)) if order else first
                    keys = (rare << np.uint64(32)) | (scattered >> np.uint64(32))
                    ranked = np.partition(keys, (short - 1, long - 1))
                    chosen = np.flatnonzero(keys <= ranked[long - 1])
                    out.append((scattered[chosen].astype(np.int64), np.full(len(chosen), sig), np.full(len(chosen), n * 8 + order * 2),
                                (keys[chosen] <= ranked[short - 1]).astype(np.int64)))
            if out:
                token, sig, info, short = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.record_batch([pa.array(token), pa.array(sig, pa.int64()), pa.array(info + short)], names=["token", "sig", "info"])

    return docs.select(F.col(text)).mapInArrow(read, "token long, sig long, info long")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray] | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each set of ``a`` (in order): the later sets of ``a``, or all sets of ``b``, that share tokens, and how many."""
    right = a if b is None else b
    every, where = np.concatenate(right), np.repeat(np.arange(len(right)), [len(x) for x in right])
    order = np.argsort(every, kind="stable")
    every, where = every[order], where[order]
    for i, tokens in enumerate(a):
        lo, hi = np.searchsorted(every, tokens, "left"), np.searchsorted(every, tokens, "right")
        width = hi - lo
        at = np.repeat(hi - np.cumsum(width), width) + np.arange(width.sum())
        shared = np.bincount(where[at], minlength=len(right))
        if b is None:
            shared[:i + 1] = 0
        found = np.flatnonzero(shared)
        yield found, shared[found]


def _verify(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The links inside one block, or between two, as stars that connect the same sets."""
    rows = rows.sort_values(["side", "n", "sig"], ignore_index=True)
    sets = [np.frombuffer(x, np.uint64) for x in rows["tokens"]]
    cut = int((rows["side"] == 0).sum())
    if not cut:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sizes, sig, parent = rows["n"].to_numpy(), rows["sig"].to_numpy(), list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    right = cut if cut < len(rows) else 0
    for i, (found, shared) in enumerate(_overlaps(sets[:cut], sets[cut:] if right else None)):
        found = found + right
        for j in found[100 * shared >= percent * (sizes[i] + sizes[found] - shared)].tolist():
            x, y = root(i), root(j)
            if x != y:
                parent[y] = x
    return _stars(np.array([root(i) for i in range(len(rows))]), sig)


def _stars(tree: np.ndarray, sig: np.ndarray) -> pd.DataFrame:
    """Edges from the smallest signature of each tree to its others; stars need no round of ``components``."""
    least = np.full(len(sig), np.iinfo(np.int64).max)
    np.minimum.at(least, tree, sig)
    least = least[tree]
    return pd.DataFrame({"a": sig[sig != least], "b": least[sig != least]}, dtype="int64")


def _near(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of ``n`` and ``m`` tokens may reach the limit, by their histograms."""
    total = n + m
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16)).sum(axis=1)
    return apart <= total - 2 * -(-percent * total // (100 + percent))


def _dense(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Edges that connect the sets of one block, or of two, which may be linked."""
    rows = rows.sort_values(["side", "n", "sig"], ignore_index=True)
    slots = np.frombuffer(b"".join(rows["slots"]), np.uint8).reshape(-1, SLOTS)
    n, sig, cut = rows["n"].to_numpy(), rows["sig"].to_numpy(), int((rows["side"] == 0).sum())
    parent = np.arange(len(rows))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    right = slice(cut, None) if cut < len(rows) else slice(0, cut)
    for i in range(cut):
        lo = np.searchsorted(n[right], -(-percent * n[i] // 100), "left") + right.start
        hi = np.searchsorted(n[right], n[i] * 100 // percent, "right") + right.start
        lo = max(lo, i + 1) if not right.start else lo
        for j in (lo + np.flatnonzero(_near(slots[lo:hi], slots[i], n[lo:hi], n[i], percent))).tolist():
            x, y = root(i), root(j)
            if x != y:
                parent[y] = x
    return _stars(np.array([root(i) for i in range(len(rows))]), sig)


SEAT = ["group", "level", "part", "other", "other_part"]


def _seats(members: DataFrame, block: int, percent: int) -> DataFrame:
    """Seats of ``group, node, n`` in blocks of about ``block`` members and in pairs of blocks whose sizes can match.

    Groups over that size are cut into levels by the ratio of sizes and those into parts by hash, so a group of any
    size is dealt without being sorted in one place; a member meets its own level and the two on either side.
    """
    dealt = members.withColumn("own", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("long"))
    held = dealt.groupBy("group", F.col("own").alias("level")).agg(F.count("*").alias("held"))
    levels = F.collect_list(F.struct("level", F.ceil(F.col("held") / block).cast("int").alias("parts")))  # few: sizes grow by a ratio
    groups = held.groupBy("group").agg(F.sum("held").alias("members"), levels.alias("levels"))
    # Most groups are one block; only the others are paired up, each member with the blocks ahead and behind.
    groups = groups.withColumn("levels", F.when(F.col("members") > block, F.col("levels")))
    one = F.col("levels").isNull()
    spread = dealt.join(groups, "group").select(
        "node", "group", F.when(one, 0).otherwise(F.col("own")).alias("own"),
        F.when(one, 0).otherwise(F.expr("pmod(xxhash64(node), filter(levels, x -> x.level = own)[0].parts)")).cast("int").alias("at"),
        F.explode(F.when(one, F.expr("array(named_struct('level', 0L, 'parts', 1))")).otherwise(
            F.expr("filter(levels, x -> x.level between own - 2 and own + 2)"))).alias("near"))
    spread = spread.select("node", "group", "own", "at", F.col("near.level").alias("far"), F.explode(F.sequence(F.lit(0), F.col("near.parts") - 1)).alias("place"))
    ahead = F.expr("far > own or far = own and place >= at")
    return spread.select(
        "node", "group", F.when(ahead, F.col("own")).otherwise(F.col("far")).alias("level"), F.when(ahead, F.col("at")).otherwise(F.col("place")).alias("part"),
        F.when(ahead, F.col("far")).otherwise(F.col("own")).alias("other"), F.when(ahead, F.col("place")).otherwise(F.col("at")).alias("other_part"),
        F.when(ahead, 0).otherwise(1).alias("side"))


def _connected(docs: DataFrame, text: str, key: str, size: int, percent: int) -> DataFrame:
    """``doc, sig, n, root`` for every row of ``docs``: its set's signature and size, and the component's signature (NULL: no shingles).

    Small tables between the steps are staged: the driver keeps a broadcast per scan and per stage of a plan and rewrites the
    whole plan after every stage, so one plan of all steps takes much of its memory.
    """
    spark = text_batches(docs.sparkSession)
    scanned = staged(scan(docs, text, key, size))
    counts = spark.sparkContext.broadcast(_sketches(scanned))  # 4 bytes a cell, whatever the corpus
    sets = scanned.filter("cell is null").select("doc", "sig", "n")
    slots = staged(scanned.filter("cell is null and n > 0").select("sig", "n", "slots").dropDuplicates(["sig", "n", "slots"]))

    # Tokens that at least two distinct sets have in a prefix under the same order. What a token's row carries is fixed by its set.
    by_token = Window.partitionBy("token", "order")
    shared = prefixes(docs, text, counts, size, percent).repartition("token").dropDuplicates(["token", "sig", "info"])
    shared = shared.select("token", "sig", F.expr("info div 8").alias("n"), F.expr("(info div 2) % 4").alias("order"), (F.col("info") % 2 == 1).alias("short"))
    shared = shared.withColumn("count", F.count("*").over(by_token)).filter("count > 1")
    shared = staged(shared)
    counts.destroy()
    few = shared.filter((F.col("order") == 0) & (F.col("count") <= DENSE))
    x, y = few.filter("short").alias("x"), few.alias("y")
    close = (F.col("x.n") * 100 >= F.col("y.n") * percent) & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.sig") < F.col("y.sig"))))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & close).select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct()

    def near(batches):
        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, SLOTS) for k in (4, 5))
            yield batch.filter(pa.array(_near(a, b, n, m, percent))).select(["a", "b"])

    sides = pairs.join(slots.select(F.col("sig").alias("a"), "n", "slots"), "a").join(slots.select(F.col("sig").alias("b"), F.col("n").alias("m"), F.col("slots").alias("more")), "b")
    pairs = staged(sides.select("a", "b", "n", "m", "slots", "more").mapInArrow(near, "a long, b long"))
    # The other orders: a pair stays only if it shares a prefix token under each.
    tokens = shared.filter("order > 0").groupBy("sig").agg(*[
        F.collect_list(F.when(F.col("order") == k, F.col("token"))).alias(f"t{k}") for k in range(1, ORDERS)])  # a part of one prefix
    for side in ("a", "b"):
        pairs = pairs.join(tokens.select(F.col("sig").alias(side), *[F.col(f"t{k}").alias(f"{side}{k}") for k in range(1, ORDERS)]), side)
    for k in range(1, ORDERS):
        pairs = pairs.filter(F.arrays_overlap(f"a{k}", f"b{k}"))
    many = shared.filter((F.col("order") == 0) & (F.col("count") > DENSE)).select(F.col("token").alias("group"), F.col("sig").alias("node"), "n")
    placed = _seats(many, WIDE, percent).join(slots, F.col("node") == F.col("sig")).select(*SEAT, "side", "sig", "n", "slots")
    dense = staged(placed.groupBy(*SEAT).applyInPandas(lambda rows: _dense(rows, percent), "a long, b long"))
    family = components(pairs.select("a", "b").union(dense))

    members = staged(family.join(slots.select(F.col("sig").alias("node"), "n"), "node").select(F.col("root").alias("group"), "node", "n"))
    seats = _seats(members, BLOCK, percent)
    marks = spark.sparkContext.broadcast(_marked(members))  # one bit a cell
    held = set_rows(docs, text, marks, size)
    placed = seats.join(held, seats["node"] == held["sig"]).select(*SEAT, "side", "sig", "n", "tokens")
    links = placed.groupBy(*SEAT).applyInPandas(lambda rows: _verify(rows, percent), "a long, b long")
    joined = components(links)
    marks.destroy()  # the links are staged in there

    return sets.join(joined.withColumnRenamed("node", "sig"), "sig", "left").select(
        "doc", "sig", "n", F.when(F.col("n") > 0, F.coalesce("root", "sig")).alias("root"))


def link(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``; a component is named by its smallest id."""
    named = _connected(docs, text, key, size, percent)
    least = named.filter("n > 0").groupBy("root").agg(F.min("doc").alias("least"))
    return named.join(least, "root", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("least")).alias("component_id"))


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that with the smallest id (NULL ids last); documents without words all stay."""
    named = _connected(docs, text, key, size, percent)
    stay = named.filter("n > 0").groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "sig")).alias("m")).select("m.doc", "m.sig")

    @F.pandas_udf("long")
    def signature(texts: pd.Series) -> pd.Series:
        return pd.Series([_signature(shingle_set(t, size)) for t in texts], dtype="int64")

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{key}`").cast("long").alias("_id"), signature(F.col(f"`{text}`")).alias("_sig"))
    empty = _signature(np.empty(0, np.uint64))
    kept = rows.join(staged(stay), (F.col("_sig") == F.col("sig")) & F.col("_id").eqNullSafe(F.col("doc")), "left_semi")
    # Rows that agree in id and words are one document.
    once = Window.partitionBy("_id", "_sig").orderBy(F.xxhash64("_row"))
    return kept.withColumn("_n", F.row_number().over(once)).filter("_n = 1").select("_row").union(rows.filter(F.col("_sig") == empty).select("_row")).select("_row.*")


def _marked(family: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit set for every signature of the table."""
    bits = np.zeros(MARKS, bool)
    bits[family.select(F.pmod("node", F.lit(MARKS)).cast("int").alias("c")).distinct().toArrow().column("c").to_numpy()] = True
    return np.packbits(bits)


def set_rows(docs: DataFrame, text: str, marks, size: int) -> DataFrame:
    """sig, n and tokens of the sets whose bit is marked; each task gives a set once."""
    def read(batches):
        seen: set[int] = set()
        bits = np.unpackbits(marks.value)
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                tokens = shingle_set(t, size)
                sig = _signature(tokens)
                if len(tokens) and bits[sig % MARKS] and sig not in seen:
                    if len(seen) > 2_000_000:
                        seen.clear()
                    seen.add(sig)
                    out.append((sig, len(tokens), tokens.tobytes()))
            sig, n, tokens = zip(*out, strict=True) if out else ((), (), ())
            yield pa.record_batch([pa.array(sig, pa.int64()), pa.array(n, pa.int64()), pa.array(tokens, pa.binary())], names=["sig", "n", "tokens"])

    return docs.select(F.col(text)).mapInArrow(read, "sig long, n long, tokens binary").dropDuplicates(["sig"])


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the component of every document."""
    return link(spark.read.parquet(f"{sf_dir}/documents.parquet"))
