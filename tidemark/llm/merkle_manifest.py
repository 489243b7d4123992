"""Merkle manifest of a dataset, checked by a recursive query that climbs from every leaf.

``build`` hashes every row to a leaf, orders the leaves of a group (source), joins every three neighbours to one node
until a group has one node left, and treats the groups' tops in the same way up to the root. The levels are stored in
bands of ``LEVELS``: a row holds a node ``LEVELS`` above, and all digests between it and the nodes below. ``nodes`` turns
these into rows that know the digests to their left and right on each level of the band and their parent at its end.
``climb`` is a recursive common table expression over these rows: each step joins the node a leaf has reached, gives out
the siblings found on the way up its band and folds the claimed digest with them, until there is no parent.

No step needs a hot key in one task. The order comes from range partitions, so a group may fill many of them. Near the
root all leaves of a group pass the same few nodes; therefore a node row is kept once for every ``BLOCK`` consecutive
leaves below it, and a leaf joins the copy of its own block. Of the nodes only those at the start of a band are needed,
so what the recursion joins is small beside the leaves.

Defined cases: every NULL column hashes as ``-``; a NULL group comes first and is another than the empty one; NULL ids
come first; rows with equal ids go by leaf, equal rows are leaves of their own; a group of one leaf has that leaf as its
top, a single group's top is the root; a leaf without siblings anywhere has the digest of nothing as its proof; an
empty table has no leaves and no root. Only the hashed columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.crc_sql import crc32_sql
from tidemark.llm.ordering import in_order
from tidemark.session import staged

FAN = 3
#: Levels that a step of the climb passes, and the nodes whose ancestor that far up is the same.
LEVELS = 3
WIDE = FAN ** LEVELS
#: Leaves that share one copy of a node row: a power of WIDE, so that blocks fall on node borders.
BLOCK = WIDE ** 2
#: The tree over the groups' tops.
TOP = -1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ordinal, tree, pos, n, leaf (binary) and carried columns; ``bands``: written levels, the lowest first; ``root``: hex or None."""

    leaves: DataFrame
    bands: list[DataFrame]
    root: str | None


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_digest(columns: Sequence[Column]) -> Column:
    """Binary SHA-256 of the columns, each as its byte count, a colon and its value, or ``-`` where NULL."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _bands(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Bands of levels, written, and the top node of every tree.

    ``nodes``: tree, pos, n (nodes of that tree on the level), digest, low and high (the leaves below). ``most`` is the
    largest n, which says how many bands there are. A written row: tree, run, band, n, kids and the digests d0 … of its
    levels; a tree's single node is not hashed again.
    """
    bands, tops = [], None
    while True:
        joined = nodes.groupBy("tree", F.expr(f"pos div {WIDE}").alias("run")).agg(
            F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "digest", "low", "high"))).alias("kids"))
        joined = joined.withColumn("d0", F.transform("kids", lambda k: k["digest"]))
        for k in range(LEVELS):
            one = f"unhex(sha2(array_join(transform(slice(d{k}, {FAN} * r + 1, {FAN}), d -> lower(hex(d))), ''), 256))"
            joined = joined.withColumn(f"d{k + 1}", F.expr(
                f"case when n > {FAN ** k} then transform(sequence(0, (size(d{k}) - 1) div {FAN}), r -> {one}) else d{k} end"))
        kids = F.transform("kids", lambda k: F.struct(k["pos"].alias("pos"), k["low"].alias("low"), k["high"].alias("high")))
        written = staged(joined.select("tree", "run", F.lit(len(bands)).alias("band"), "n", kids.alias("kids"), *[f"d{k}" for k in range(LEVELS)],
                                       F.expr(f"d{LEVELS}[0]").alias("digest")))
        bands.append(written)
        nodes = written.select("tree", F.col("run").alias("pos"), F.expr(f"(n + {WIDE - 1}) div {WIDE}").alias("n"), "digest",
                               F.expr("kids[0].low").alias("low"), F.expr("kids[size(kids) - 1].high").alias("high"))
        done = nodes.filter("n = 1")
        tops = done if tops is None else tops.unionByName(done)
        most = -(-most // WIDE)
        if most <= 1:
            return bands, tops
        nodes = nodes.filter("n > 1")


def build(rows: DataFrame, group: str, by: Sequence[str], leaf: str = "leaf") -> Manifest:
    """Order the leaves of every group and build all levels. ``rows`` has the group, the order columns and the leaf digest."""
    ordered = in_order(rows, [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in by], F.col(leaf)])
    pieces = staged(ordered.groupBy(group, "part").agg(F.min("ordinal").alias("low"), F.count(F.lit(1)).alias("k")))
    groups = in_order(pieces.groupBy(group).agg(F.min("low").alias("start"), F.sum("k").alias("n")), [F.col("start")], "tree", "_p")
    size = groups.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("most")).first()
    # Through the pieces, since a group's own rows may fill many partitions: a key of this join fills one at most.
    pieces = pieces.drop("low", "k").withColumn("_g", F.col(group)).join(
        groups.withColumnRenamed(group, "_h"), F.col("_g").eqNullSafe(F.col("_h"))).select(
        F.col("_g"), F.col("part").alias("_part"), "start", "n", "tree")
    leaves = staged(ordered.join(pieces, F.col(group).eqNullSafe(F.col("_g")) & (F.col("part") == F.col("_part"))).withColumn(
        "pos", F.col("ordinal") - F.col("start")).drop("_g", "_part", "part", "start"))
    if not size["groups"]:
        return Manifest(leaves, [], None)
    bottom = leaves.select("tree", "pos", "n", F.col(leaf).alias("digest"), F.col("ordinal").alias("low"), F.col("ordinal").alias("high"))
    bands, tops = _bands(bottom, size["most"])
    summit = staged(tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(size["groups"]).cast("long").alias("n"), "digest", "low", "high"))
    if size["groups"] == 1:
        return Manifest(leaves, bands, summit.select(hexed(F.col("digest"))).first()[0])
    above, last = _bands(summit, size["groups"])
    return Manifest(leaves, bands + above, last.select(hexed(F.col("digest"))).first()[0])


def _rows(band: DataFrame) -> DataFrame:
    """The nodes at the start of a band: per level what stands left (b0 …) and right (a0 …), NULL on levels that are not hashed; own digest; parent."""
    rows = band.select("tree", "band", "run", "n", *[f"d{k}" for k in range(LEVELS)], F.posexplode("kids").alias("i", "kid"))
    beside, at = {}, "i"
    for k in range(LEVELS):
        joined = f"case when n > {FAN ** k} then unhex(array_join(transform(slice(d{k}, {{}}), d -> hex(d)), '')) end"
        first = f"{at} div {FAN} * {FAN}"
        beside[f"b{k}"] = F.expr(joined.format(f"{first} + 1, {at} - {first}"))
        beside[f"a{k}"] = F.expr(joined.format(f"{at} + 2, {first} + {FAN - 1} - {at}"))
        at = f"({at} div {FAN})"
    top = (F.col("n") <= WIDE) & (F.col("tree") != TOP)  # the run's node is its group's top, known to the tree above by the group's number
    return rows.select(
        "tree", "band", F.col("kid.pos").alias("pos"), F.col("kid.low").alias("low"), F.col("kid.high").alias("high"), *[c.alias(n) for n, c in beside.items()],
        F.when((F.col("tree") == TOP) & (F.col("band") == 0), F.expr("d0[i]")).alias("own"),
        F.when(top, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("up_tree"), F.when(top, F.lit(0)).otherwise(F.col("band") + 1).alias("up_band"),
        F.when(top, F.col("tree")).otherwise(F.col("run")).alias("up_pos"))


def nodes(manifest: Manifest) -> DataFrame:
    """All nodes at the start of a band above the leaves, a row for every block of leaves below."""
    every = None
    for band in manifest.bands:
        rows = _rows(band).where((F.col("band") > 0) | (F.col("tree") == TOP))
        every = rows if every is None else every.unionByName(rows)
    return every.withColumn("block", F.explode(F.expr(f"sequence(low div {BLOCK}, high div {BLOCK})"))).drop("low", "high")


def _folded(start: str) -> str:
    """SQL: a digest after all levels of a band."""
    for k in range(LEVELS):
        start = f"case when n.b{k} is null then {start} else unhex(sha2(concat(lower(hex(n.b{k})), lower(hex({start})), lower(hex(n.a{k}))), 256)) end"
    return start


def climb(manifest: Manifest, claimed: Column) -> DataFrame:
    """Every leaf's way to the root from a claimed digest: ordinal, proof (SHA-256 of the siblings' hex digests), top and folded, all binary."""
    spark = manifest.leaves.sparkSession
    siblings = ", ".join(f"coalesce(n.{side}{k}, unhex(''))" for k in range(LEVELS) for side in "ba")
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # the climb has a row per leaf and band, whatever the number of leaves
    try:
        steps = spark.sql(f"""
            with recursive up (ordinal, step, tree, band, pos, folded, siblings, own) as (
                select l.ordinal, 0, n.up_tree, n.up_band, n.up_pos, {_folded("l.claimed")}, concat({siblings}), n.own
                from {{leaves}} l join {{first}} n on n.low = l.ordinal
                union all
                select up.ordinal, up.step + 1, n.up_tree, n.up_band, n.up_pos, {_folded("up.folded")}, concat({siblings}), n.own
                from up join {{nodes}} n on n.tree = up.tree and n.band = up.band and n.pos = up.pos and n.block = up.ordinal div {BLOCK})
            select ordinal, array_sort(collect_list(struct(step, folded, siblings, own))) as way from up group by ordinal
            """, leaves=manifest.leaves.select("ordinal", claimed.alias("claimed")), first=_rows(manifest.bands[0]), nodes=staged(nodes(manifest)))
        ways = steps.select(
            "ordinal", F.expr("unhex(sha2(array_join(transform(way, w -> lower(hex(w.siblings))), ''), 256))").alias("proof"),
            F.expr("get(filter(way, w -> w.own is not null), 0).own").alias("top"), F.expr("way[size(way) - 1].folded").alias("folded"))
        return staged(ways)
    finally:
        spark.conf.set(limit, before)


def verify(manifest: Manifest, claimed: Column, *keep: str) -> DataFrame:
    """Per leaf: the kept columns, leaf, subroot, root, proof_sha256, folded_root and verified, all digests in hex."""
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.leaves.select(*keep).schema)
    if not manifest.bands:
        return manifest.leaves.sparkSession.createDataFrame(
            [], f"{shape}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    ways = climb(manifest, claimed)
    root = F.lit(manifest.root).cast("string")
    folded = hexed(F.col("folded"))
    return manifest.leaves.select("ordinal", "leaf", *keep).join(ways, "ordinal").select(
        *keep, hexed(F.col("leaf")).alias("leaf"), F.coalesce(hexed(F.col("top")), root).alias("subroot"), root.alias("root"),
        hexed(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"), (folded == root).alias("verified"))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every document's proof, and whether it still verifies where every second id lost its line breaks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    forged = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    hit = forged.isNotNull() & (forged != F.col("text"))
    rows = docs.select(
        "doc_id", "source", row_digest([F.col(c) for c in COLUMNS]).alias("leaf"),
        F.when(hit, row_digest([*[F.col(c) for c in COLUMNS[:-1]], forged])).alias("forged"))
    return verify(build(rows, "source", ["doc_id"]), F.coalesce("forged", "leaf"), "doc_id")


def _digest_sql(text: str) -> str:
    parts = [f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


SQL = f"""
with recursive
d as (select *, case when {crc32_sql("doc_id::varchar")} % 2 = 0 then replace(text, chr(10), '') else text end as bad from documents),
l as (select doc_id, source, dense_rank() over (order by source nulls first) - 1 as tree, {_digest_sql("text")} as leaf, {_digest_sql("bad")} as claim from d),
o as (select *, row_number() over w - 1 as pos, count(*) over (partition by tree) as n from l window w as (partition by tree order by doc_id nulls first, leaf)),
s(tree, level, pos, n, h) as (
    select tree, 0, pos, n, leaf from o
    union all
    select tree, level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' order by pos)) from s where n > 1 group by tree, level, pos // 3),
u(tree, level, pos, n, h) as (
    select -1, 0, tree, count(*) over (), h from s where n = 1
    union all
    select -1, level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' order by pos)) from u where n > 1 group by level, pos // 3),
a as (select tree, level, pos, n, h from s union all select * from u),
q as (select a.tree, a.level, a.pos, a.n, coalesce(string_agg(b.h, '' order by b.pos) filter (where b.pos < a.pos), '') as before,
             coalesce(string_agg(b.h, '' order by b.pos) filter (where b.pos > a.pos), '') as after
      from a join a b on a.tree = b.tree and a.level = b.level and a.pos // 3 = b.pos // 3 where a.n > 1 group by a.tree, a.level, a.pos, a.n),
r as (select *, tree >= 0 and n <= 3 as top, case when top then -1 else tree end as up_tree, case when top then 0 else level + 1 end as up_level,
             case when top then tree else pos // 3 end as up_pos from q),
c(id, tree, level, pos, f, proof) as (
    select rowid, case when n = 1 then -1 else tree end, 0, case when n = 1 then tree else pos end, claim, '' from (select *, row_number() over () as rowid from o)
    union all
    select id, up_tree, up_level, up_pos, sha256(before || f || after), proof || before || after from c join r using (tree, level, pos)),
t as (select h as root from u where n = 1),
z as (select *, row_number() over () as id from o)
select doc_id, leaf, s.h as subroot, root, sha256(proof) as proof_sha256, f as folded_root, f = root as verified
from z join c using (id) join s on s.tree = z.tree and s.n = 1 cross join t
where not exists (select 1 from r where r.tree = c.tree and r.level = c.level and r.pos = c.pos)
"""
