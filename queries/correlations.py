"""Alignment, correlation and factor queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import adapters as a
from tidemark.operators import align as al
from tidemark.operators import correlation as co
from tidemark.operators import factors as fa
from tidemark.session import staged

Q, SQL = {}, {}


def query(name, sql=None):
    def register(fn):
        Q[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def assets(spark, d):
    """Weekly prices of all assets; written once, since matrices read them several times."""
    return staged(a.prices_long(spark, d).withColumnRenamed("symbol", "asset"))


PAIRS = f"""{a.PRICES_LONG},
assets as (select count(distinct symbol) as k from prices),
complete as (select date from prices group by date having count(*) = (select k from assets)),
cr as (select asset_class, symbol, date, value from prices where date in (select date from complete)),
pv as materialized (select x.symbol as symbol_1, y.symbol as symbol_2, x.date, x.value as v1, y.value as v2, x.asset_class as class_1, y.asset_class as class_2
  from cr x join cr y on x.date = y.date and x.symbol < y.symbol)"""

STOCKS, COINS, INDICES = ("AF", "AO", "NF", "NO", "RF", "RO"), ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), ("^R0", "^R1", "^R2", "^R3", "^R4")


@query("align_outer", f"with {a.PRICES_LONG} select date, " + ", ".join(f"max(value) filter (symbol = '{s}') as \"{s}\"" for s in STOCKS) + " from prices where asset_class = 'stock' group by date")
def align_outer(spark, d):
    return al.align_outer(assets(spark, d), STOCKS, ["stock"])


@query("align_cross_class", f"""with {a.PRICES_LONG} select x.date, x.symbol as stock, y.symbol as coin, x.value as stock_value, y.value as coin_value
from prices x join prices y on x.date = y.date where x.asset_class = 'stock' and y.asset_class = 'crypto'""")
def align_cross_class(spark, d):
    both = al.align_classes(assets(spark, d), "stock", "crypto")
    return both.withColumnsRenamed({"left": "stock", "right": "coin", "left_value": "stock_value", "right_value": "coin_value"})


@query("align_all_classes", f"with {a.PRICES_LONG} select date, " + ", ".join(f"max(value) filter (symbol = '{s}') as \"{s}\"" for s in (*STOCKS, *COINS, *INDICES)) + " from prices group by date")
def align_all_classes(spark, d):
    return al.align_outer(assets(spark, d), [*STOCKS, *COINS, *INDICES])


@query("align_range", f"""with {a.PRICES_LONG}, r as (select * from prices where date between date '1996-01-01' and date '1997-06-30')
select asset_class, symbol as asset, date, value from r where symbol in (select symbol from r group by 1 having count(*) >= 60)""")
def align_range(spark, d):
    """A date range, and only the assets with enough rows in it."""
    return al.enough_rows(al.in_range(assets(spark, d), "1996-01-01", "1997-06-30"), 60)


@query("corr_pearson", f"with {PAIRS} select symbol_1, symbol_2, round(corr(v1, v2), 6) as corr, count(*) as n from pv group by 1, 2")
def corr_pearson(spark, d):
    return co.pearson(assets(spark, d)).select("symbol_1", "symbol_2", F.round("corr", 6).alias("corr"), "n")


@query("corr_spearman", f"""with {PAIRS},
rk as (select symbol, date, rank() over (partition by symbol order by value) + (count(*) over (partition by symbol, value) - 1) / 2.0 as r from cr)
select x.symbol as symbol_1, y.symbol as symbol_2, round(corr(x.r::double, y.r::double), 6) as corr, count(*) as n
from rk x join rk y on x.date = y.date and x.symbol < y.symbol group by 1, 2""")
def corr_spearman(spark, d):
    return co.spearman(assets(spark, d)).select("symbol_1", "symbol_2", F.round("corr", 6).alias("corr"), "n")


@query("corr_kendall", f"""with {PAIRS}, sg as (select x.symbol_1, x.symbol_2, sign(x.v1 - y.v1) as a, sign(x.v2 - y.v2) as b
  from pv x join pv y on x.symbol_1 = y.symbol_1 and x.symbol_2 = y.symbol_2 and x.date < y.date)
select symbol_1, symbol_2, round(sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))), 6) as corr from sg group by 1, 2""")
def corr_kendall(spark, d):
    return co.kendall(assets(spark, d)).select("symbol_1", "symbol_2", F.round("corr", 6).alias("corr"))


@query("corr_stats", f"""with {PAIRS}, m as (select symbol_1, symbol_2, corr(v1, v2) as c from pv group by 1, 2)
select round(avg(c), 6) as avg_correlation, round(min(c), 6) as min_correlation, round(max(c), 6) as max_correlation,
  arg_min(symbol_1, c) as least_1, arg_min(symbol_2, c) as least_2, arg_max(symbol_1, c) as most_1, arg_max(symbol_2, c) as most_2 from m""")
def corr_stats(spark, d):
    out = co.matrix_statistics(co.pearson(assets(spark, d)))
    return out.select(*[F.round(c, 6).alias(c) for c in ("avg_correlation", "min_correlation", "max_correlation")], "least_1", "least_2", "most_1", "most_2")


YEARS = [(f"y{y}", f"{y}-01-01", f"{y + 1}-01-01") for y in range(1995, 2002)]
ALL_PAIRS = """ap as (select x.symbol as symbol_1, y.symbol as symbol_2, x.date, x.value as v1, y.value as v2
  from prices x join prices y on x.date = y.date and x.symbol < y.symbol)"""
PERIOD_VALUES = ", ".join(f"('{n}', date '{s}', date '{e}')" for n, s, e in YEARS)


@query("corr_by_period", f"""with {a.PRICES_LONG}, {ALL_PAIRS}, periods(period, s, e) as (values {PERIOD_VALUES}),
ok as (select period from (select distinct date from prices) join periods on date between s and e group by 1 having count(*) >= 5)
select period, symbol_1, symbol_2, round(corr(v1, v2), 6) as corr, count(*) as n from ap join periods on date between s and e
where period in (select period from ok) group by 1, 2, 3""")
def corr_by_period(spark, d):
    periods = [(n, F.lit(s).cast("date"), F.lit(e).cast("date")) for n, s, e in YEARS]
    return co.by_period(assets(spark, d), periods).select("period", "symbol_1", "symbol_2", F.round("corr", 6).alias("corr"), "n")


@query("corr_period_change", f"""with {a.PRICES_LONG}, {ALL_PAIRS}, mid as (select min(date) + (date_diff('day', min(date), max(date)) // 2)::int as m from prices),
h as (select symbol_1, symbol_2, corr(v1, v2) filter (date <= m) as f, corr(v1, v2) filter (date >= m) as s from ap, mid group by 1, 2)
select symbol_1, symbol_2, round(f, 6) as first_half, round(s, 6) as second_half, round(s - f, 6) as change from h""")
def corr_period_change(spark, d):
    out = co.period_change(assets(spark, d))
    return out.select("symbol_1", "symbol_2", *[F.round(c, 6).alias(c) for c in ("first_half", "second_half", "change")])


CLASS_PAIRS = [("stock", "crypto"), ("stock", "index"), ("crypto", "index")]


@query("corr_cross_class", f"""with {a.PRICES_LONG}, blocks(block, ca, cb) as (values {", ".join(f"('{x}_{y}', '{x}', '{y}')" for x, y in CLASS_PAIRS)}),
r as (select block, prices.* from prices join blocks on asset_class in (ca, cb)),
ok as (select block, date from r group by 1, 2 having count(*) = (select count(distinct symbol) from r r2 where r2.block = r.block)),
c as (select r.* from r join ok using (block, date)),
m as (select x.block, x.symbol as symbol_1, y.symbol as symbol_2, corr(x.value, y.value) as c, count(*) as n from c x join c y
  on x.block = y.block and x.date = y.date and x.symbol < y.symbol and x.asset_class <> y.asset_class group by 1, 2, 3 having count(*) > 10)
select block, round(avg(c), 6) as avg_correlation, round(min(c), 6) as min_correlation, round(max(c), 6) as max_correlation,
  arg_min(symbol_1, c) as least_1, arg_min(symbol_2, c) as least_2, arg_max(symbol_1, c) as most_1, arg_max(symbol_2, c) as most_2 from m group by block""")
def corr_cross_class(spark, d):
    out = co.matrix_statistics(co.cross_class(assets(spark, d), CLASS_PAIRS), ["block"])
    return out.select("block", *[F.round(c, 6).alias(c) for c in ("avg_correlation", "min_correlation", "max_correlation")], "least_1", "least_2", "most_1", "most_2")


ROLL = """rl as (select symbol_1, symbol_2, date, row_number() over w as k, corr(v1, v2) over (w rows 29 preceding) as c from pv
  window w as (partition by symbol_1, symbol_2 order by date))"""


@query("corr_rolling", f"with {PAIRS}, {ROLL} select symbol_1, symbol_2, date, round(c, 6) as corr from rl where k >= 30")
def corr_rolling(spark, d):
    return co.rolling(assets(spark, d), 30).select("symbol_1", "symbol_2", "date", F.round("corr", 6).alias("corr"))


@query("corr_rolling_spearman", f"""with {PAIRS}, l as (select symbol_1, symbol_2, date, list(v1) over w as a, list(v2) over w as b, count(*) over w as k from pv
  window w as (partition by symbol_1, symbol_2 order by date rows 29 preceding)),
r as (select symbol_1, symbol_2, date, list_transform(a, lambda x: list_sum(list_transform(a, lambda y: case when y < x then 1.0 when y = x then 0.5 else 0 end))) as ra,
  list_transform(b, lambda x: list_sum(list_transform(b, lambda y: case when y < x then 1.0 when y = x then 0.5 else 0 end))) as rb from l where k = 30),
u as (select symbol_1, symbol_2, date, unnest(ra) as x, unnest(rb) as y from r)
select symbol_1, symbol_2, date, round(corr(x::double, y::double), 6) as corr from u group by 1, 2, 3""")
def corr_rolling_spearman(spark, d):
    return co.rolling(assets(spark, d), 30, "spearman").select("symbol_1", "symbol_2", "date", F.round("corr", 6).alias("corr"))


@query("corr_rolling_kendall", f"""with {PAIRS}, l as (select symbol_1, symbol_2, date, list(v1) over w as a, list(v2) over w as b, count(*) over w as k from pv
  window w as (partition by symbol_1, symbol_2 order by date rows 29 preceding)),
ij as (select i, j from range(1, 31) x(i), range(1, 31) y(j) where i < j),
s as (select symbol_1, symbol_2, date, sign(a[i] - a[j]) as x, sign(b[i] - b[j]) as y from l, ij where k = 30)
select symbol_1, symbol_2, date, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) as corr from s group by 1, 2, 3""")
def corr_rolling_kendall(spark, d):
    return co.rolling(assets(spark, d), 30, "kendall").select("symbol_1", "symbol_2", "date", F.round("corr", 6).alias("corr"))


@query("corr_rolling_stats", f"""with {PAIRS}, {ROLL} select symbol_1, symbol_2, round(avg(c), 6) as avg_correlation, round(stddev_pop(c), 6) as correlation_volatility,
round(max(c) - min(c), 6) as correlation_change from rl where k >= 30 group by 1, 2""")
def corr_rolling_stats(spark, d):
    out = co.rolling_statistics(assets(spark, d), 30)
    return out.select("symbol_1", "symbol_2", *[F.round(c, 6).alias(c) for c in ("avg_correlation", "correlation_volatility", "correlation_change")])


REGIME = f"""{a.PRICES_LONG}, grid as (select date, row_number() over (order by date) as rn from (select distinct date from prices)),
syms as (select distinct symbol from prices),
f as (select x.symbol as symbol_1, y.symbol as symbol_2, rn, grid.date, p.value as v1, q.value as v2 from grid, syms x join syms y on x.symbol < y.symbol
  left join prices p on p.symbol = x.symbol and p.date = grid.date left join prices q on q.symbol = y.symbol and q.date = grid.date),
w as (select symbol_1, symbol_2, rn, date, corr(v1, v2) over (partition by symbol_1, symbol_2 order by rn rows between 30 preceding and 1 preceding) as before,
  corr(v1, v2) over (partition by symbol_1, symbol_2 order by rn rows between current row and 29 following) as after from f),
z as (select *, abs(after - before) as change from w where rn > 30 and rn <= (select max(rn) from grid) - 29),
dd as (select date, round(case when count(change) = count(*) then avg(change) end, 6) as difference from z group by date)"""


@query("corr_adjacent_diff", f"with {REGIME} select date, difference from dd")
def corr_adjacent_diff(spark, d):
    return co.adjacent_difference(assets(spark, d), 30, 0.3).select("date", F.round("difference", 6).alias("difference"))


THRESHOLD = 0.15  # weekly means move little; low enough to find changes


@query("corr_regime_change", f"""with recursive {REGIME}, c as (select date, difference, row_number() over (order by date) as k from dd where difference > {THRESHOLD}),
fold as (select 1::bigint as k, date as last, date as kept from c where k = 1
  union all select c.k, case when date_diff('day', last, c.date) > 15 then c.date else last end, case when date_diff('day', last, c.date) > 15 then c.date end from fold join c on c.k = fold.k + 1),
tp as (select date, symbol_1, symbol_2, round(before, 6) as before, round(after, 6) as after, round(change, 6) as change,
  row_number() over (partition by date order by change desc, symbol_1, symbol_2) as rank from z where change > {THRESHOLD})
select dd.date, difference, rank::int as rank, symbol_1, symbol_2, before, after, change from dd join fold on fold.kept = dd.date join tp on tp.date = dd.date where rank <= 5""")
def corr_regime_change(spark, d):
    out = co.regime_changes(assets(spark, d), 30, THRESHOLD, digits=6)
    out = out.select("date", "difference", F.posexplode("changed").alias("pos", "p"))
    return out.select("date", "difference", (F.col("pos") + 1).alias("rank"), "p.symbol_1", "p.symbol_2",
                      *[F.round(f"p.{c}", 6).alias(c) for c in ("before", "after", "change")])


@query("corr_top_volatile_pairs", f"""with {PAIRS}, {ROLL}, st as (select symbol_1, symbol_2, stddev_pop(c) as v from rl where k >= 30 group by 1, 2 order by v desc limit 5),
pp as (select x.symbol as symbol_1, y.symbol as symbol_2, x.date, x.value as v1, y.value as v2 from st join prices x on x.symbol = st.symbol_1 join prices y on y.symbol = st.symbol_2 and x.date = y.date),
rr as (select symbol_1, symbol_2, date, row_number() over w as k, corr(v1, v2) over (w rows 29 preceding) as c from pp window w as (partition by symbol_1, symbol_2 order by date))
select symbol_1, symbol_2, date, round(c, 6) as corr from rr where k >= 30""")
def corr_top_volatile_pairs(spark, d):
    return co.top_pair_series(assets(spark, d), 30, 5).select("symbol_1", "symbol_2", "date", F.round("corr", 6).alias("corr"))


MATRIX = f"""{PAIRS}, mx as (select symbol_1, symbol_2, corr(v1, v2) as c from pv group by 1, 2)"""

#: One merge per round, the closest pair of clusters by mean distance; a cluster goes by its smallest member.
LINKAGE = f"""{MATRIX}, ds as materialized (select symbol_1 as s, symbol_2 as t, 1 - abs(c) as d from mx union all select symbol_2, symbol_1, 1 - abs(c) from mx),
cl(k, s, c) as (select (select count(distinct s) from ds), s, s from (select distinct s from ds) union all
  select k - 1, s, case when c = q then p else c end from cl, (select arg_min(p, m) as p, arg_min(q, m) as q from (
    select x.c as p, y.c as q, avg(d) as m from cl x join cl y on x.c < y.c join ds on ds.s = x.s and ds.t = y.s group by 1, 2)) where k > 3)"""


@query("corr_clusters", f"""with recursive {LINKAGE}, f as (select s as symbol, c from cl where k = 3), g as (select c, row_number() over (order by c) - 1 as cluster, count(*) as members from f group by c),
i as (select x.c, avg(mx.c) as m from mx join f x on x.symbol = symbol_1 join f y on y.symbol = symbol_2 and y.c = x.c group by 1)
select symbol, cluster::int as cluster, members, round(coalesce(m, 1.0), 6) as intra_correlation from f join g using (c) left join i using (c)""")
def corr_clusters(spark, d):
    m = staged(co.pearson(assets(spark, d)))
    labels = staged(fa.average_linkage(m, 3))
    return labels.join(fa.within_clusters(m, labels), "cluster").select(
        "symbol", "cluster", "members", F.round("intra_correlation", 6).alias("intra_correlation"))


def dominant_sql(matrix: str, out: str) -> str:
    """Leading eigenvector and value of a matrix (rows i, list x): the matrix is squared again and again, its columns then all point along it."""
    return f"""{out}_p(k, m) as (select 0, list(x order by i) from {matrix} union all
  select k + 1, list_transform(n, lambda r: list_transform(r, lambda y: y / t)) from (select k, n, sqrt(list_sum(list_transform(n, lambda r: list_sum(list_transform(r, lambda y: y * y))))) as t
    from (select k, list_transform(m, lambda r: list_transform(m, lambda s: list_sum(list_transform(list_zip(r, s), lambda z: z[1] * z[2])))) as n from {out}_p where k < 40))),
{out}_c as (select list_transform(m, lambda r: r[j]) as v from (select m, list_position(g, list_max(g)) as j from (select m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) as g from {out}_p where k = 40))),
{out}_v as (select list_transform(v, lambda y: y / sqrt(list_sum(list_transform(v, lambda z: z * z)))) as v from {out}_c),
{out}_l as (select v, list_sum(list_transform(list_zip(v, (select list(list_sum(list_transform(list_zip(x, v), lambda z: z[1] * z[2])) order by i) from {matrix})), lambda z: z[1] * z[2])) as l from {out}_v)"""


SQUARE = f"""{MATRIX}, names as (select symbol, row_number() over (order by symbol) as i from (select symbol_1 as symbol from mx union select symbol_2 from mx)),
cells as (select s.i, t.i as j, coalesce(c, 1.0) as x from names s cross join names t left join mx on (symbol_1 = s.symbol and symbol_2 = t.symbol) or (symbol_1 = t.symbol and symbol_2 = s.symbol)),
ma as materialized (select i, list(x order by j) as x from cells group by i), {dominant_sql("ma", "one")},
mb as materialized (select ma.i, list_transform(list_zip(x, v), lambda z: z[1] - l * v[ma.i] * z[2]) as x from ma, one_l), {dominant_sql("mb", "two")}"""


@query("pca_factors", f"""with recursive {SQUARE} select 'PC1' as component, round(l / (select count(*) from names), 6) as explained_ratio, (select count(*) from names) as assets from one_l
union all select 'PC2', round(l / (select count(*) from names), 6), (select count(*) from names) from two_l""")
def pca_factors(spark, d):
    out = fa.principal_components(assets(spark, d), 2)
    return out.groupBy("component").agg(F.round(F.first("explained_ratio"), 6).alias("explained_ratio"), F.count(F.lit(1)).alias("assets"))


@query("pca_contributions", f"""with recursive {SQUARE}, e as (select 'PC1' as component, v from one_l union all select 'PC2', v from two_l),
u as (select component, symbol, v[i] * case when v[list_position(list_transform(v, lambda z: round(abs(z), 12)), list_max(list_transform(v, lambda z: round(abs(z), 12))))] < 0 then -1 else 1 end as x from e, names)
select component, symbol, round(x, 5) as loading, round(abs(x), 5) as contribution, (row_number() over (partition by component order by round(abs(x), 12) desc, symbol))::int as rank from u""")
def pca_contributions(spark, d):
    out = fa.principal_components(assets(spark, d), 2)
    return out.select("component", "symbol", F.round("loading", 5).alias("loading"), F.round("contribution", 5).alias("contribution"), "rank")
