"""Correlation against pandas and brute force, with several tiles and blocks."""

import itertools

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import correlation as co
from tidemark.operators import factors as fa
from tidemark.operators import ranking


@pytest.fixture(scope="module")
def prices(spark):
    rng = np.random.default_rng(3)
    n, names = 150, list("ABCDEFG")
    base = np.cumsum(rng.normal(size=(n, 2)), axis=0)
    wide = pd.DataFrame(base @ rng.normal(size=(2, len(names))) + rng.normal(size=(n, len(names))), columns=names)
    wide = wide.round(1)  # ties
    wide.index = pd.date_range("2015-01-05", periods=n, freq="W-MON").date
    wide.iloc[10, 2] = np.nan
    wide.iloc[40:43, 5] = np.nan
    long = wide.stack().reset_index()
    long.columns = ["date", "asset", "value"]
    return wide, spark.createDataFrame(long, "date date, asset string, value double").cache()


@pytest.fixture(params=["one tile", "many tiles"])
def tiles(request, monkeypatch):
    if request.param == "many tiles":
        for name, value in (("TILE_ASSETS", 2), ("ROLLING_TILE_ASSETS", 3), ("DAYS_PER_STRETCH", 200), ("DATES_PER_BLOCK", 32), ("KENDALL_TILE_ASSETS", 2), ("PAIRS_AT_ONCE", 200)):
            monkeypatch.setattr(co, name, value)


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r["corr"] for r in df.collect()}


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_matrix_over_complete_rows(prices, tiles, method):
    wide, df = prices
    full = wide.dropna()
    got = as_dict(co.METHODS[method](df), "symbol_1", "symbol_2")
    assert len(got) == 21
    for a, b in itertools.combinations(full.columns, 2):
        if method == "kendall":
            i, j = np.triu_indices(len(full), 1)
            x, y = (np.sign(full[c].to_numpy()[i] - full[c].to_numpy()[j]) for c in (a, b))
            want = (x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum())
        else:
            ranks = full.rank() if method == "spearman" else full
            want = np.corrcoef(ranks[a], ranks[b])[0, 1]
        assert got[a, b] == pytest.approx(want, abs=1e-10)


def test_discordant_pairs_by_merging():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 8, 9, 100):
        y = rng.integers(0, max(2, n // 2), (n, 5))
        want = [sum(y[a, c] > y[b, c] for a in range(n) for b in range(a + 1, n)) for c in range(5)]
        assert co.discordant(y).tolist() == want


def test_ranks_of_a_hot_group(spark):
    """One group has most rows, one value most of them; the group fills several ranges and the ranks are pandas'."""
    rng = np.random.default_rng(2)
    n = 6000
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.8, "hot", rng.choice(list("abc"), n)), "k": np.arange(n)})
    pdf["v"] = np.where(rng.random(n) < 0.4, 5.0, np.round(rng.normal(5, 3, n), 2))
    pdf.loc[0, "v"], pdf.loc[1, "v"] = -0.0, 0.0
    df = spark.createDataFrame(pdf).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.average_ranks(df, ["g"], "v", "k").toPandas().set_index("k")["rank"].sort_index()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = pdf.set_index("k").groupby("g")["v"].rank()
    assert (got == want).all()
    assert ranking.average_ranks(df.limit(0), ["g"], "v", "k").collect() == []


def test_pairwise_uses_shared_rows(prices, tiles):
    wide, df = prices
    got = {(r.symbol_1, r.symbol_2): (r.corr, r.n) for r in co.pairwise(df).collect()}
    for a, b in itertools.combinations(wide.columns, 2):
        both = wide[[a, b]].dropna()
        assert got[a, b] == (pytest.approx(np.corrcoef(both[a], both[b])[0, 1], abs=1e-10), len(both))


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_rolling(prices, tiles, method):
    wide, df = prices
    full = wide.dropna()
    got = as_dict(co.rolling(df, 30, method), "symbol_1", "symbol_2", "date")
    assert len(got) == 21 * (len(full) - 29)
    for a, b in [("A", "B"), ("C", "G")]:
        for end in (29, 60, len(full) - 1):
            part = full.iloc[end - 29: end + 1]
            part = part.rank() if method == "spearman" else part
            assert got[a, b, full.index[end]] == pytest.approx(np.corrcoef(part[a], part[b])[0, 1], abs=1e-9)


def test_rolling_statistics(prices, tiles):
    wide, df = prices
    full = wide.dropna()
    r = full["A"].rolling(30).corr(full["D"]).dropna()
    row = co.rolling_statistics(df, 30).where("symbol_1 = 'A' and symbol_2 = 'D'").first()
    assert row.avg_correlation == pytest.approx(r.mean()) and row.correlation_volatility == pytest.approx(r.std(ddof=0))
    assert row.correlation_change == pytest.approx(r.max() - r.min())


def brute_regimes(wide, w, threshold):
    out = []
    for i in range(len(wide) - 2 * w + 1):
        a, b = (wide.iloc[i + k: i + k + w].corr().to_numpy() for k in (0, w))
        up = np.triu_indices_from(a, 1)
        diff = np.abs(a[up] - b[up]).mean()
        if diff > threshold:
            out.append((wide.index[i + w], diff))
    kept = out[:1]
    for day, diff in out[1:]:
        if (day - kept[-1][0]).days > w / 2:
            kept.append((day, diff))
    return kept


def test_regime_changes(prices, tiles):
    wide, df = prices
    want = brute_regimes(wide, 20, 0.25)
    got = co.regime_changes(df, 20, 0.25).orderBy("date").collect()
    assert len(want) > 2
    assert [(r.date, pytest.approx(r.difference, abs=1e-9)) for r in got] == want
    for r in got:
        assert len(r.changed) <= 5 and [p.change for p in r.changed] == sorted((p.change for p in r.changed), reverse=True)


def test_constant_asset_has_no_correlation(spark):
    days = pd.date_range("2020-01-01", periods=20).date
    rows = [(d, a, float(i) if a == "x" else 0.1) for i, d in enumerate(days) for a in ("x", "flat")]
    df = spark.createDataFrame(rows, "date date, asset string, value double")
    assert [r["corr"] for r in co.pearson(df).collect()] == [None]
    assert {r["corr"] for r in co.rolling(df, 5).collect()} == {None}


def brute_linkage(corr, k):
    names = list(corr.columns)
    d = (1 - corr.abs()).to_numpy()
    groups = [[i] for i in range(len(names))]
    while len(groups) > k:
        pairs = [(np.mean([d[i, j] for i in a for j in b]), x, y) for x, a in enumerate(groups) for y, b in enumerate(groups) if x < y]
        _, x, y = min(pairs)
        groups[x] += groups.pop(y)
    return {frozenset(names[i] for i in g) for g in groups}


@pytest.mark.parametrize("k", [1, 3, 5, 7])
def test_average_linkage(spark, k):
    rng = np.random.default_rng(11)
    x = pd.DataFrame(rng.normal(size=(60, 3)) @ rng.normal(size=(3, 9)) + rng.normal(size=(60, 9)), columns=list("abcdefghi"))
    corr = x.corr()
    rows = [("g", a, b, float(corr.loc[a, b])) for a, b in itertools.combinations(corr.columns, 2)]
    m = spark.createDataFrame(rows, "grp string, symbol_1 string, symbol_2 string, corr double")
    labels = fa.average_linkage(m, k, ["grp"])
    found = {}
    for r in labels.collect():
        found.setdefault(r.cluster, set()).add(r.symbol)
    assert {frozenset(v) for v in found.values()} == brute_linkage(corr, k)
    assert [min(found[c]) for c in sorted(found)] == sorted(min(v) for v in found.values())
    inside = {r.cluster: r.intra_correlation for r in fa.within_clusters(m, labels, ["grp"]).collect()}
    for c, members in found.items():
        pairs = [corr.loc[a, b] for a, b in itertools.combinations(sorted(members), 2)]
        assert inside[c] == pytest.approx(np.mean(pairs) if pairs else 1.0)


def test_principal_components(prices):
    wide, df = prices
    z = wide.dropna()
    values, vectors = np.linalg.eigh(np.corrcoef(z.to_numpy().T))
    got = fa.principal_components(df, 2).toPandas()
    for c, (i, name) in enumerate(((-1, "PC1"), (-2, "PC2"))):
        part = got[got.component == name].sort_values("symbol")
        v = vectors[:, i] * np.sign(vectors[np.abs(vectors[:, i]).argmax(), i])
        np.testing.assert_allclose(part["loading"], v, atol=1e-8)
        assert part["explained_ratio"].iat[0] == pytest.approx(values[i] / values.sum())
        assert part.sort_values("rank")["contribution"].is_monotonic_decreasing
