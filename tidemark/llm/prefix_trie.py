"""Prefix trie of conversations, rolled up by bands of depths.

A node is a distinct sequence of first turns; all conversations that start with it are its members. ``paths`` gives
every conversation's prefixes with two 64-bit words that stand for the prefix: the exclusive or over hashes of (depth,
turn), so they add up over blocks of turns and no conversation has to be walked in one task. ``trie`` joins prefixes to
nodes by aggregation.

Sums over subtrees (``roll_up``) work on bands of ``BAND`` depths. A node gives its value to its ancestors inside the
band, at most ``BAND`` rows however deep the trie is. The roots of the bands then hold their band's totals and form a
trie of their own, a band as high in it as one node; its sums are found in the same way, and each band root's completed
total goes to its ancestors in the band above. Rounds grow with the logarithm of the depth to the base ``BAND``.

Hot keys: turns are numbered over range partitions, a conversation's turns are joined by (conversation, partition) and
accumulated by (conversation, block); members are counted before the shuffle; children look their parent up by (parent,
bucket of the child), so even a node with most of all children is spread. The list of the conversations that end in a
node is hashed as a stream of short sorted stretches; SHA-256 being sequential, one task reads a node's stretches, in
constant memory and with a row for up to ``STRETCH`` conversations.

Defined cases: NULL role or text is empty; NULL turns come first; equal turns of a conversation go by the hash of role
and text, so repeated rows count as turns of their own; rows without a conversation id belong to no conversation and are
left out; a conversation may be of any length or, rebuilt, without turns; an empty table has no nodes, not even a root.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.crc_sql import crc32_sql
from tidemark.llm.ordering import in_order
from tidemark.llm.text import whole
from tidemark.session import staged

BAND = 32
#: Turns accumulated by one task's window: a multiple of the band.
BLOCK = 1024
#: Buckets in which a node's children look it up.
BUCKETS = 1024
#: log2 of the conversation ids in a sorted stretch.
STRETCH = 9
#: Family size and length of the shared beginning in the rebuilt conversations.
FAMILY, SHARED = 100, 6

PATH = ["p1", "p2"]


def numbered(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): conv_id, part, pos (from 1), x, y (hash of role and text), chars; and conv_id, part, n."""
    said, by = whole(F.col(text)), whole(F.col(role))
    digest = F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256)
    turns = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("_s"), F.length(said).cast("long").alias("chars"))
    turns = turns.select("conv_id", "turn", "chars", *[F.conv(F.substring("_s", at, 15), 16, 10).cast("long").alias(c) for c, at in (("x", 1), ("y", 16))])
    ordered = in_order(turns, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("x"), F.col("y")])
    pieces = staged(ordered.groupBy("conv_id", "part").agg(F.min("ordinal").alias("low"), F.count(F.lit(1)).alias("k")))
    whole_ones = pieces.groupBy("conv_id").agg(F.min("low").alias("start"), F.sum("k").alias("n"))
    pieces = staged(pieces.select("conv_id", "part").join(whole_ones, "conv_id"))
    turns = ordered.join(pieces.select("conv_id", "part", "start"), ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("ordinal") - F.col("start") + 1).alias("pos"), "x", "y", "chars")
    return turns, pieces.select("conv_id", "part", "n")


def rebuilt(turns: DataFrame, pieces: DataFrame) -> DataFrame:
    """The conversations with the beginnings of their family: conv_id, depth, x, y, chars, length; depth 0 is the textless start."""
    base, shared = F.expr(f"conv_id - conv_id % {FAMILY}"), F.crc32(F.col("conv_id").cast("string")) % SHARED
    convs = pieces.select("conv_id", "n").distinct().withColumn("base", base).withColumn("h", shared)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("m"))
    convs = staged(convs.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("m", F.lit(0)))).select(
        "conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    own = turns.join(pieces.join(convs, "conv_id").select("conv_id", "part", "h", "k", "length"), ["conv_id", "part"]).filter("pos > h").select(
        "conv_id", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "x", "y", "chars", "length")
    # At most SHARED - 1 rows of a base conversation, each for at most FAMILY conversations.
    heads = turns.filter(f"conv_id % {FAMILY} = 0 and pos < {SHARED}").select(F.col("conv_id").alias("base"), "pos", "x", "y", "chars")
    lent = convs.filter("k > 0").join(heads, "base").filter("pos <= h").select("conv_id", F.col("pos").alias("depth"), "x", "y", "chars", "length")
    none = F.lit(0).cast("long")
    starts = convs.select("conv_id", *[none.alias(c) for c in ("depth", "x", "y", "chars")], "length")
    return own.unionByName(lent).unionByName(starts)


def paths(rows: DataFrame) -> DataFrame:
    """Add the words of every prefix to rows of conv_id, depth (from 0 without a gap), x, y and whatever else."""
    g1, g2 = F.xxhash64("depth", "x", "y"), F.xxhash64("y", F.lit(17), "depth", "x")
    rows = staged(rows.withColumns({"_g1": F.when(F.col("depth") > 0, g1).otherwise(F.lit(0)), "_g2": F.when(F.col("depth") > 0, g2).otherwise(F.lit(0)),
                                    "_block": F.expr(f"depth div {BLOCK}")}))
    so_far = Window.partitionBy("conv_id", "_block").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block of long conversations
    carried = rows.filter(f"length >= {BLOCK}").groupBy("conv_id", "_block").agg(F.bit_xor("_g1").alias("_c1"), F.bit_xor("_g2").alias("_c2"))
    carried = carried.select("conv_id", "_block", *[F.bit_xor(c).over(before).alias(c) for c in ("_c1", "_c2")])
    rows = rows.withColumns({f"p{i}": F.bit_xor(f"_g{i}").over(so_far) for i in (1, 2)}).join(carried, ["conv_id", "_block"], "left")
    total = {f"p{i}": F.col(f"p{i}").bitwiseXOR(F.coalesce(F.col(f"_c{i}"), F.lit(0))) for i in (1, 2)}
    return rows.withColumns(total).drop("x", "y", "_g1", "_g2", "_c1", "_c2", "_block")


def with_ancestors(rows: DataFrame) -> DataFrame:
    """Add ``above``: the paths from the start of the band in which depth - 1 lies down to depth - 1 (the root of all: empty)."""
    edge = (F.col("depth") > 0) & (F.col("depth") % BAND == 0)
    group = F.expr(f"depth div {BAND}")
    # The first row of a band is the last reader of the band above, too.
    both = rows.withColumn("_group", F.explode(F.when(edge, F.array(group - 1, group)).otherwise(F.array(group))))
    earlier = Window.partitionBy("conv_id", "_group").orderBy("depth").rowsBetween(-BAND, -1)
    both = both.withColumn("above", F.collect_list(F.struct(*PATH)).over(earlier))
    return both.filter(~edge | (F.col("_group") < group)).drop("_group")


def roll_up(nodes: DataFrame, rows: DataFrame, measures: Sequence[str], deepest: int) -> DataFrame:
    """Sums of the measures over every node's subtree: p1, p2 and the measures.

    ``nodes``: p1, p2, conv_id (a member), depth, above and the measures; ``rows``: conv_id, depth, p1, p2 of all members.
    """
    self, top = F.array(F.struct(*PATH)), F.col("depth") % BAND == 0
    sums = [F.sum(m).alias(m) for m in measures]

    def give(df: DataFrame, to: Column) -> DataFrame:
        return df.select(F.explode(to).alias("_to"), *measures).groupBy(F.col("_to.p1").alias("p1"), F.col("_to.p2").alias("p2")).agg(*sums)

    inside = give(nodes, F.when(top, self).otherwise(F.concat(self, "above")))
    if deepest < BAND:
        return inside
    inside = staged(inside)
    roots = nodes.filter(top).select(*PATH, "conv_id", "depth", "above").join(inside, PATH)
    band_rows = rows.filter(top).select("conv_id", F.expr(f"depth div {BAND}").alias("depth"), *PATH)
    higher = with_ancestors(band_rows).select("conv_id", "depth", F.col("above").alias("_above"))
    roots = staged(roots.join(higher.withColumn("depth", F.col("depth") * BAND), ["conv_id", "depth"]))
    coarse = roots.select(*PATH, "conv_id", F.expr(f"depth div {BAND}").alias("depth"), F.col("_above").alias("above"), *measures)
    totals = roll_up(coarse, band_rows, measures, deepest // BAND)
    through = give(roots.filter("depth > 0").select(*PATH, "above").join(totals, PATH), F.col("above"))
    return inside.unionByName(through).groupBy(*PATH).agg(*sums)


def _stream_hash(batches):
    """SHA-256 over stretches that arrive by path, then in order: one row per path, in constant memory."""
    path, state, names = None, None, [*PATH, "ends_sha256"]
    for batch in batches:
        done = []
        for p1, p2, stretch in zip(*(batch.column(c).to_pylist() for c in (*PATH, "ids")), strict=True):
            if path == (p1, p2):
                state.update(b",")
            else:
                if path:
                    done.append((*path, state.hexdigest()))
                path, state = (p1, p2), hashlib.sha256()
            state.update(stretch.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                                          pa.array([d[2] for d in done], pa.string())], names=names)
    if path:
        yield pa.RecordBatch.from_arrays([pa.array([path[0]], pa.int64()), pa.array([path[1]], pa.int64()), pa.array([state.hexdigest()], pa.string())], names=names)


def end_digests(ends: DataFrame) -> DataFrame:
    """p1, p2 and the SHA-256 of the comma-joined ascending conversation ids of each path."""
    stretches = ends.groupBy(*PATH, F.shiftright("conv_id", STRETCH).alias("_at")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return stretches.repartition(*PATH).sortWithinPartitions(*PATH, "_at").select(*PATH, "ids").mapInArrow(_stream_hash, "p1 long, p2 long, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """The nodes over rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = staged(with_ancestors(paths(rows)))
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    nodes = rows.groupBy(*PATH).agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"))
    nodes = nodes.join(rows.select("conv_id", "depth", "above"), ["conv_id", "depth"])
    nodes = staged(nodes.withColumn("up", F.expr("get(above, size(above) - 1)")).withColumn("bucket", F.pmod(F.xxhash64("conv_id"), F.lit(BUCKETS))))
    kids = staged(nodes.filter("depth > 0").groupBy(F.col("up.p1").alias("p1"), F.col("up.p2").alias("p2"), "bucket").agg(F.count(F.lit(1)).alias("k")))
    counts = kids.groupBy(*PATH).agg(F.sum("k").alias("n_children"))
    parents = kids.select(*PATH, "bucket").join(nodes.select(*PATH, F.col("conv_id").alias("parent_conv_id")), PATH).select(
        F.col("p1").alias("u1"), F.col("p2").alias("u2"), "bucket", "parent_conv_id")
    valued = staged(nodes.join(counts, PATH, "left").select(
        *PATH, "conv_id", "depth", "above", "up", "bucket", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")))
    totals = roll_up(valued.select(*PATH, "conv_id", "depth", "above", "n_leaves", "saved_tokens"), rows.select("conv_id", "depth", *PATH),
                     ["n_leaves", "saved_tokens"], deepest)
    out = valued.select(*PATH, "conv_id", "depth", "n_convs", "n_children", F.col("up.p1").alias("u1"), F.col("up.p2").alias("u2"), "bucket").join(
        totals, PATH).join(end_digests(rows.filter("depth = length").select(*PATH, "conv_id")), PATH, "left").join(parents, ["u1", "u2", "bucket"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the trie over all conversations, each rebuilt on the beginning of its family's first."""
    return trie(rebuilt(*numbered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


SQL = f"""
with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
                  row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
           from conversations where conv_id is not null),
v as (select distinct c, c - c % {FAMILY} as base, {crc32_sql("c::varchar")} % {SHARED} as h from t),
r as (select v.c, t.pos as p, role, text from v join t on t.c = v.base and t.pos <= h union all select c, {SHARED} + pos, role, text from t join v using (c) where pos > h),
s as (select *, row_number() over (partition by c order by p) as d from r),
l as (select v.c, coalesce(list(strlen(role) || ':' || role || ':' || strlen(text) || ':' || text order by d) filter (where d is not null), []) as turns,
             coalesce(list(length(text) order by d) filter (where d is not null), []) as chars from v left join s using (c) group by v.c),
x as (select c, len(turns) as n, unnest(range(len(turns) + 1)) as d, turns, chars from l),
m as (select c, n, d, turns[1:d] as path, case when d > 0 then chars[d] else 0 end as chars from x),
n as (select path, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * max(chars) as saved,
             sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where n = d), '')) as ends from m group by path),
k as (select path[1:depth - 1] as path, count(*) as n_children from n where depth > 0 group by 1),
w as (select n.*, coalesce(n_children, 0) as n_children from n left join k using (path)),
e as (select path[1:a] as path, case when n_children = 0 then 1 else 0 end as leaf, saved from (select *, unnest(range(depth + 1)) as a from w)),
u as (select path, sum(leaf) as n_leaves, sum(saved) as saved_tokens from e group by path)
select w.conv_id, w.depth, o.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, w.ends as ends_sha256
from w join u using (path) left join n o on w.depth > 0 and o.path = w.path[1:w.depth - 1]
"""
