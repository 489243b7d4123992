"""Document quality as a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins; the model is one lookup table per feature and one per chosen pair of
features, learned by cyclic boosting: in turn, every feature gets a shallow tree over its bins, fitted to the
current residuals and added in with a small step; then the pairs that explain most of what is left get their
own turns. A score is the logistic of a sum of table entries, so it can be read term by term (``explain``).

Learning takes a bounded sample (``max_rows`` labelled rows, those with the smallest id hashes): only their
features reach the driver. Scoring is one pass over all texts: features and table additions run on Arrow
batches in the tasks that read the rows, without a shuffle, so skewed sources make no difference.

Defined cases: NULL text is scored as the empty one, which has a score as well; NULL ids are never learned from
and not held out; labels other than 0 and 1 are not learned from; with no labelled rows, or one class only, all
scores are the smoothed share of label 1; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows to learn from, at most.
MAX_ROWS = 20_000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, STEP, MIN_LEAF = 24, 150, 60, 6, 0.1, 5
FEATURES = (
    "log_words", "word_length", "space_share", "digit_share", "upper_share", "symbol_share", "stop_share", "bang_share", "pipe_share",
    "wide_share", "distinct_share", "top_share", "pair_repeats", "line_repeats", "words_per_line", "longest_word",
)
_SYMBOLS = np.frombuffer(b"#*$%&<>@^~_=+\\{}[]", np.uint8)


def features(text: str) -> list[float]:
    """The values of :data:`FEATURES` for one whole text."""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(int(counts[65:91].sum() + counts[97:123].sum()), 1)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        float(np.log1p(len(words))), sum(map(len, words)) / n, (int(counts[32]) + int(counts[9:14].sum())) / size,
        int(counts[48:58].sum()) / size, int(counts[65:91].sum()) / letters, int(counts[_SYMBOLS].sum()) / size,
        int(counts[46]) / n, int(counts[33]) / n, int(counts[124]) / n, int(counts[128:].sum()) / size,
        len(tally) / n, max(tally.values(), default=0) / n, 1 - (pairs + 1) / n if len(words) > 1 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1), len(words) / max(len(lines), 1), float(np.log1p(max(map(len, words), default=0))),
    ]


@dataclass
class Model:
    """Bin edges per feature, a table per feature, and a table per pair of features."""

    intercept: float
    edges: list[np.ndarray]
    single: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.single):
            total += table[b[:, j]]
        for (j, k), table in self.pairs.items():
            total += table[b[:, j], b[:, k]]
        return 1 / (1 + np.exp(-total))

    def explain(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What every term adds to each row's log odds."""
        b = self.bins(x)
        return {FEATURES[j]: t[b[:, j]] for j, t in enumerate(self.single)} | {
            f"{FEATURES[j]} x {FEATURES[k]}": t[b[:, j], b[:, k]] for (j, k), t in self.pairs.items()}


def _cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins into two parts, by gradient and curvature sums."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = np.where((nl >= MIN_LEAF) & (nr >= MIN_LEAF), gl * gl / (hl + 1) + gr * gr / (hr + 1) - g.sum() ** 2 / (h.sum() + 1), 0)
    return (0.0, 0) if len(gain) == 0 or gain.max() <= 1e-9 else (float(gain.max()), int(gain.argmax()) + 1)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A tree of at most ``leaves`` leaves over a row of bins, as one value per bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((*_cut(g[a:b], h[a:b], n[a:b]), i) for i, (a, b) in enumerate(parts)), key=lambda x: x[0])
        if not best[1]:
            break
        a, b = parts.pop(best[2])
        parts += [(a, a + best[1]), (a + best[1], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts one feature and then the other in each half: gain and a value per cell."""
    best, out = 0.0, np.zeros(g.shape)
    for flip in (False, True):
        G, H, N = (x.T if flip else x for x in (g, h, n))
        for at in range(1, G.shape[0]):
            gain, value = 0.0, np.zeros(G.shape)
            for side in (slice(0, at), slice(at, None)):
                gs, hs, ns = G[side].sum(0), H[side].sum(0), N[side].sum(0)
                won, place = _cut(gs, hs, ns)
                gain += won + gs.sum() ** 2 / (hs.sum() + 1)
                for part in (slice(0, place), slice(place, None)):
                    value[side, part] = gs[part].sum() / (hs[part].sum() + 1) if gs[part].size else 0
            gain -= G.sum() ** 2 / (H.sum() + 1)
            if gain > best:
                best, out = gain, value.T if flip else value
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learn the tables from feature rows and 0/1 labels."""
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    columns = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        return Model(intercept, [np.empty(0)] * columns, [np.zeros(1)] * columns)
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) for j in range(columns)]
    model = Model(intercept, edges, [np.zeros(len(e) + 1) for e in edges])
    b = model.bins(x)
    total = np.full(len(y), intercept)

    def sums(cells: np.ndarray, size: int):
        p = 1 / (1 + np.exp(-total))
        return (np.bincount(cells, w, size) for w in (y - p, p * (1 - p), None))

    for _ in range(ROUNDS):
        for j in range(columns):
            step = STEP * _tree(*sums(b[:, j], len(edges[j]) + 1))
            model.single[j] += step
            total += step[b[:, j]]
    # Pairs are ranked on coarse cells by what a two-level tree gains on the residuals that are left.
    coarse = b // 4
    ranked = []
    for j in range(columns):
        for k in range(j + 1, columns):
            shape = (len(edges[j]) // 4 + 1, len(edges[k]) // 4 + 1)
            grids = [s.reshape(shape) for s in sums(coarse[:, j] * shape[1] + coarse[:, k], shape[0] * shape[1])]
            ranked.append((_pair_tree(*grids)[0], j, k))
    chosen = [(j, k) for gain, j, k in sorted(ranked, key=lambda r: (-r[0], r[1:]))[:PAIRS] if gain > 0]
    for j, k in chosen:
        model.pairs[j, k] = np.zeros((len(edges[j]) + 1, len(edges[k]) + 1))
    for _ in range(PAIR_ROUNDS):
        for (j, k), table in model.pairs.items():
            grids = [s.reshape(table.shape) for s in sums(b[:, j] * table.shape[1] + b[:, k], table.size)]
            step = STEP * _pair_tree(*grids)[1]
            table += step
            total += step[b[:, j], b[:, k]]
    return model


def held_out(key: Column) -> Column:
    """True for a third of the documents, by the checksum of their id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _feature_rows(texts: pa.Array) -> np.ndarray:
    return np.array([features(t or "") for t in texts.to_pylist()], float).reshape(-1, len(FEATURES))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit the model on at most ``max_rows`` labelled documents that are not held out."""
    chosen = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col(label).alias("_y")).orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "_y")  # max_rows pairs of numbers

    def take(batches):
        for batch in batches:
            x = _feature_rows(batch.column(0))
            yield pa.record_batch([batch.column(1).cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    found = rows.mapInArrow(take, "y int, x array<double>").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, found["y"].to_numpy())) if len(x) else slice(0)  # the same model whatever order rows arrive in
    return fit(x[order], found["y"].to_numpy(float)[order])


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and score of every document."""
    def add(batches):
        for batch in batches:
            values = model.score(_feature_rows(batch.column(1))) if batch.num_rows else np.empty(0)
            yield pa.record_batch([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(add, "doc_id long, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: held_out, score and predicted label of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
