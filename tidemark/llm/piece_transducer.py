"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from a model file: the normaliser (space to the piece mark, a mark in front), the
pieces (a path of characters in, an id out) and the byte fallback (any other character in, ids of its bytes out).
An input is composed with them arc by arc, and its encoding is the shortest path in the tropical semiring (weights
add along a path, the least total wins).

Unigram models weigh an arc by the piece's negative log probability. A merge model (BPE) has no such weights: a
path spells its result exactly if each two neighbouring pieces would stay apart when merged from characters
on their own. Its arcs therefore weigh 0 from a compatible last piece and infinity from others, with the fallback
at 1; the state of the composition is the position with the last piece, and at most one has a finite weight.

No piece joins a character to a mark after it, and newlines have no piece, so a text falls into units that are
encoded once per task and kept in a table of bounded size.

Defined cases: NULL and empty texts have no ids; every text decodes to itself if the model's normaliser is the
identity; repeated rows get equal ids; only id and text are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
REMEMBER = 700_000
_UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*")


class Transducer:
    """Encoder and decoder compiled from a SentencePiece model file."""

    def __init__(self, path: str, remember: int = REMEMBER):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces or not model.normalizer_spec.add_dummy_prefix:
            raise ValueError("only identity normalisers with a mark in front are compiled")
        kinds = proto.ModelProto.SentencePiece
        self.merges = model.trainer_spec.model_type == proto.TrainerSpec.BPE
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.spelled = [b"" if p.type in (kinds.CONTROL, kinds.UNKNOWN) else bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE
                        else p.piece.encode() for p in model.pieces]
        plain = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.score = {p: s for p, (_, s) in plain.items()}
        self.longest = max(map(len, plain))
        # A piece that its own characters never merge into is on no path of a merge model.
        self.arcs = {p: i for p, (i, _) in plain.items() if not self.merges or self._merged(p) == [p]}
        self.names = [p.piece for p in model.pieces]
        self.paths = ahocorasick.Automaton()  # the pieces' paths in one automaton: all that end at a character, longest first
        for piece, i in self.arcs.items():
            self.paths.add_word(piece, (len(piece), i))
        self.paths.make_automaton()
        self.apart: dict[int, bool] = {}
        self.remember, self.known = remember, {}

    def _merged(self, text: str) -> list[str]:
        """Pieces after merging the best-scored neighbours, leftmost first, until none is left."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _compatible(self, a: int, b: int) -> bool:
        """Whether two pieces in a row stay apart; nothing merges with a character of the fallback (-1)."""
        if a < 0:
            return True
        if len(self.apart) > 4 * self.remember:
            self.apart.clear()
        one, two = self.names[a], self.names[b]
        known = self.apart[a << 20 | b] = self._merged(one + two) == [one, two]
        return known

    def _merge_path(self, unit: str) -> bytes:
        n, apart = len(unit), self.apart
        last, size = [-1] * (n + 1), [1] * (n + 1)  # the piece that ends here on the only path of finite weight
        done = -1
        for end, (length, piece) in self.paths.iter(unit):
            if end == done:
                continue
            at = end + 1 - length
            if at:
                before = last[at]
                ok = apart.get(before << 20 | piece)
                if ok is None:
                    ok = self._compatible(before, piece)
                if not ok:
                    continue
            last[end + 1], size[end + 1], done = piece, length, end
        out: list[int] = []
        while n:
            if last[n] < 0:
                out += [self.bytes[b] for b in reversed(unit[n - 1].encode("utf-8", "surrogatepass"))]
            else:
                out.append(last[n])
            n -= size[n]
        return np.array(out[::-1], "<u4").tobytes()

    def _weighted_path(self, unit: str) -> list[str]:
        n = len(unit)
        cost, back = [0.0] + [float("inf")] * n, [0] * (n + 1)
        worst = min(self.score.values(), default=0.0) - 10.0
        for j in range(1, n + 1):
            cost[j], back[j] = cost[j - 1] - worst, j - 1
            for i in range(max(0, j - self.longest), j):
                score = self.score.get(unit[i:j])
                if score is not None and cost[i] - score < cost[j]:
                    cost[j], back[j] = cost[i] - score, i
        out, at = [], n
        while at:
            out.append(unit[back[at]:at])
            at = back[at]
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        """Ids on the shortest path through a unit."""
        if self.merges:
            return self._merge_path(unit)
        ids: list[int] = []
        for piece in self._weighted_path(unit):
            ids += [self.arcs[piece]] if piece in self.arcs else [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, np.uint32)
        units = _UNITS.findall(MARK + text.replace(" ", MARK))
        known = self.known
        try:
            raw = b"".join(map(known.__getitem__, units))
        except KeyError:
            if len(known) > self.remember:
                known.clear()
            for unit in units:
                if unit not in known:
                    known[unit] = self._unit(unit)
            raw = b"".join(map(known.__getitem__, units))
        return np.frombuffer(raw, "<u4")

    def decode(self, ids) -> str:
        """The text of ids: pieces and bytes in a row, marks as spaces, without the mark in front."""
        raw = b"".join(map(self.spelled.__getitem__, ids)).replace(MARK.encode(), b" ")
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


_compiled: dict[str, Transducer] = {}


def _transducer(path: str) -> Transducer:
    """One transducer per model and worker process."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def encode(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and ids of every document."""
    def run(batches):
        machine = _transducer(model)
        for batch in batches:
            coded = [machine.encode(t or "") for t in batch.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(coded).astype(np.int32) if coded else np.empty(0, np.int32)))
            yield pa.record_batch([batch.column(0), ids], names=["doc_id", "ids"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, model: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """doc_id and text of rows of ids."""
    def run(batches):
        machine = _transducer(model)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([machine.decode(x or ()) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return coded.select(F.col(key).cast("long"), F.col(ids)).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, ids, their number, and whether they decode to the text."""
    def run(batches):
        machine = _transducer(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            coded = [machine.encode(t) for t in texts]
            same = [machine.decode(c.tolist()) == t for c, t in zip(coded, texts, strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(coded).astype(np.int32) if coded else np.empty(0, np.int32)))
            yield pa.record_batch([batch.column(0), ids, pa.array([len(c) for c in coded], pa.int64()), pa.array(same, pa.bool_())],
                                  names=["doc_id", "ids", "n_ids", "decodes"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, ids array<int>, n_ids long, decodes boolean")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: the ids of every document, and whether they decode to its text."""
    import public_tokenizers

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
