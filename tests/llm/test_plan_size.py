"""What the driver holds while near copies are sought: the tables that one plan reads, and the seats that are dealt in one pass."""

import math
import random
from collections import defaultdict

import pytest
from test_operators import prose

from tidemark.llm import components, jaccard_join


def test_near_copies_run_as_small_plans(spark, monkeypatch):
    """A plan's scans and stages each have a broadcast in the driver's memory, and its text is written anew after every stage."""
    reads = []

    def counted(df, keep=jaccard_join.staged):
        reads.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return keep(df)

    monkeypatch.setattr(jaccard_join, "staged", counted)
    monkeypatch.setattr(components, "staged", counted)
    rng = random.Random(4)
    base = prose(rng, 200)
    docs = spark.createDataFrame([(k, base + f" end{k}") for k in range(30)] + [(50 + k, prose(rng, 80)) for k in range(5)] + [(70, None), (71, "")], "doc_id long, text string")
    kept = jaccard_join.deduplicate(docs)
    assert {r.doc_id for r in kept.collect()} == {0, *range(50, 55), 70, 71}
    assert max(reads) <= 5  # one read 49


@pytest.mark.parametrize("block", [3, 1000])
def test_seats(spark, block):
    rng, percent = random.Random(5), 80
    rows = [(g, 1000 * g + k, rng.choice((1, 3, 4, 5, 6, 8, 20, 21, 400))) for g, size in enumerate((1, 3, 4, 40)) for k in range(size)]
    members = spark.createDataFrame(rows, "`group` long, node long, n long")
    part = dict(members.selectExpr("node", "xxhash64(node)").collect())
    groups = defaultdict(list)
    for g, node, n in rows:
        groups[g].append((node, math.floor(math.log(n) / math.log(100 / percent))))
    want = []
    for g, found in groups.items():
        if len(found) <= block:
            want += [(node, g, 0, 0, 0, 0, 0) for node, _ in found]
            continue
        parts = {x: -(-sum(y == x for _, y in found) // block) for _, x in found}
        for node, own in found:
            at = part[node] % parts[own]
            for far in parts:
                for place in range(parts[far] if abs(far - own) <= 2 else 0):
                    want.append((node, g, own, at, far, place, 0) if (far, place) >= (own, at) else (node, g, far, place, own, at, 1))
    seats = jaccard_join._seats(members, block, percent)
    assert seats.columns == ["node", *jaccard_join.SEAT, "side"]
    assert sorted(map(tuple, seats.collect())) == sorted(want)
    assert seats._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2  # it was 16
