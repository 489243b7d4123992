"""How many jobs near copies take: each stage of each leaves a broadcast and a plan with the driver."""

import random

import numpy as np
import pytest
from test_operators import prose

from tidemark.llm import components, jaccard_join


@pytest.fixture
def tables(monkeypatch):
    """The tables that components write."""
    made = []
    monkeypatch.setattr(components, "staged", lambda df, keep=components.staged: made.append(df) or keep(df))
    return made


@pytest.mark.parametrize("edges", [[], [(5, 5)], [(9, 1), (1, 4), (7, 2), (8, 2), (4, 1)]])
def test_stars_take_no_round(spark, tables, edges):
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == ([(1, 1), (2, 2), (4, 1), (7, 2), (8, 2), (9, 1)] if len(edges) > 1 else [])
    assert len(tables) == 1  # it was 3 for the stars


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3)], [(3, 1), (3, 2)], [(1, 2), (2, 3), (3, 1), (4, 5)]])
def test_others_do(spark, tables, edges):
    found = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {n: 1 if n < 4 else 4 for e in edges for n in e} and len(tables) > 1


def test_links_of_a_block_are_stars():
    sig = np.array([5, -3, 9, 7, -8, 2])
    stars = jaccard_join._stars(np.array([0, 0, 2, 3, 2, 0]), sig)
    assert sorted(zip(stars["a"].tolist(), stars["b"].tolist(), strict=True)) == [(2, -3), (5, -3), (9, -8)]
    assert jaccard_join._stars(np.array([0]), sig[:1]).empty and str(stars.dtypes.iloc[0]) == "int64"


def test_near_copies_in_few_jobs(spark, tables):
    rng = random.Random(6)
    rows = []
    for k in range(12):
        base = prose(rng, 150).split(" ")
        for j in range(6):  # a chain: neighbours are near, the ends are not
            rows.append((100 * k + j, " ".join([*base[:-4 * j or None], *prose(rng, 4 * j).split(" ")])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in jaccard_join.deduplicate(docs).collect()} >= {100 * k for k in range(12)}
    assert len(tables) <= 4  # it was 6
