"""BPE encoding by speculation: greedy longest matches first, exact merging only where they cannot be right.

``Codec`` reads a tokenizer file with merges that end words by a suffix. A word's symbols are proposed as the longest
vocabulary entries from the left. The proposal is the exact encoding if and only if every token is what its own text
encodes to and every two neighbours stay apart: undoing both tokens' merges from the last one backwards shows each pair
of symbols that ever stood side by side at their border, and none of these pairs may have a merge that came before
either side was taken further. All pairs of a batch of new words are tested together, as arrays. Words with a pair
that fails are merged exactly, all of them side by side; a very long one by a heap over (rank, place).

Texts go over in Arrow batches. What a worker remembers of words is bounded in bytes, not in entries, and holds no
answer that depends on what came before, so any split into tasks gives the same ids. Nothing is shuffled and a text stays
where it was read, however hot its source is.

Defined cases: NULL and empty texts have no ids and decode to the empty text; ids outside the vocabulary and NULL ids
stop decoding with an error that names them; repeated rows are encoded each; an empty table gives no rows; a column of
the input that clashes with an output column is not kept, others are not read. Text after decoding is what the
tokenizer itself gives: lower case, without the original white space.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

#: Bytes of stretches of text and their ids a worker keeps, half of them met lately.
REMEMBER = 96 << 20
#: Longer words are encoded whenever they occur and not kept.
KEEP_LENGTH = 256
#: Letters beyond which a word is merged by a heap.
LONG_WORD = 64
#: Stands for the end of a word inside symbols; a text's own such character is one of the byte letters by then.
END = "\0"

#: Byte-level models show a byte as the character of its number if printable, all others as those from 256 on, in order.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOW = {b: chr(b) for b in _PLAIN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}


class _Table:
    """Non-negative codes to numbers, looked up for whole arrays: open addressing, the next slot where one is taken."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(codes)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.codes, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):
            free = self.codes[slot[left]] < 0
            taken, first = np.unique(slot[left[free]], return_index=True)
            won = left[free][first]
            self.codes[taken], self.values[taken] = codes[won], values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask  # all of these slots are taken by now

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, codes: np.ndarray, missing: int) -> np.ndarray:
        out = np.full(len(codes), missing, np.int64)
        live, slot = np.arange(len(codes)), self._slot(codes)
        while len(live):
            found = self.codes[slot]
            hit = found == codes
            out[live[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            live, slot, codes = live[on], (slot[on] + 1) & self.mask, codes[on]
        return out


class Codec:
    """The tables of one tokenizer file and the words met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or not suffix:
            raise ValueError(f"a merge model with word ends is needed; not supported here: {odd or model['type']}")
        self._steps(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        if any(t[:1] != "<" for t in self.special):
            raise ValueError("special tokens are expected to start with <")
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.vocab = {(t[:-len(suffix)] + END if t.endswith(suffix) else t): i for t, i in model["vocab"].items()}
        self.size = 1 + max(chain(model["vocab"].values(), self.special.values()))
        names = [None] * self.size
        for t, i in chain(model["vocab"].items(), self.special.items()):
            names[i] = t
        self.names = np.asarray(names, object)
        inner = [tuple(x[:-len(suffix)] + END if x.endswith(suffix) else x for x in (m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        self.result = [self.vocab[a + b] for a, b in inner]
        self.order = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in reversed(list(enumerate(inner)))}
        self._tables()
        self._spell()
        self.known = np.asarray([n is not None for n in names])
        self.chunks: dict[str, bytes] = {}  # lately met, and met before the last time that half the memory was full
        self.older: dict[str, bytes] = {}
        self.kept = 0

    def _steps(self, spec: dict) -> None:
        """Check that the text rules are those this codec knows: composed, white space to one space, lower case, a pattern, bytes."""
        rules = [n["type"] for n in spec["normalizer"]["normalizers"]]
        cut = spec["pre_tokenizer"]["pretokenizers"]
        if rules != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cut] != ["Split", "ByteLevel"] or cut[1]["add_prefix_space"] or cut[1]["use_regex"] or not (
                cut[0]["invert"] and cut[0]["behavior"] == "Removed") or spec["post_processor"] or spec["decoder"]:
            raise ValueError("this tokenizer's text rules are not supported")
        # Which characters are letters and what their lower case is changes with Unicode; beyond ASCII the tokenizer's own tables say so.
        self.ascii_word = regex.compile(cut[0]["pattern"]["Regex"].replace("\\s", "\\p{White_Space}"))
        self.cut = pre_tokenizers.Split(Regex(cut[0]["pattern"]["Regex"]), "removed", invert=True)
        self.rules = Tokenizer.from_str(json.dumps(spec)).normalizer

    def _tables(self) -> None:
        """Per symbol the merge that made it, and which symbols encode to themselves; per pair the rank of its merge."""
        merges = sorted((r, a, b, self.result[r]) for (a, b), r in self.order.items())
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        self.made = np.full(self.size, -1)  # rank of the merge that makes a symbol; -1: a single letter
        for r, a, b, c in reversed(merges):  # a symbol with several merges is made by the first
            self.left[c], self.right[c], self.made[c] = a, b, r
        self.pairs = _Table(np.asarray([a * self.size + b for _, a, b, _ in merges], np.int64), np.asarray([m[0] for m in merges], np.int64))
        self.results = np.asarray(self.result, np.int64)
        made = np.nonzero(self.made >= 0)[0]
        apart = np.ones(self.size, bool)
        apart[made] = self.stay_apart(self.left[made], self.right[made], inside=True)
        self.sound = np.zeros(self.size, bool)
        single = np.asarray([i for t, i in self.vocab.items() if len(t.rstrip(END)) == 1 and self.made[i] < 0], int)
        self.sound[single] = True
        for c in made[np.argsort(self.made[made])].tolist():
            self.sound[c] = apart[c] and self.sound[self.left[c]] and self.sound[self.right[c]]

    def _spell(self) -> None:
        """Ids of the 256 byte letters inside and at the end of a word, and the tree of all sound entries over these letters."""
        self.letters = np.asarray([self.vocab[c + e] for e in ("", END) for c in map(_SHOW.__getitem__, range(256))], np.int64)
        byte = {c: b for b, c in _SHOW.items()}
        children: dict[int, int] = {}
        entry = [-1]  # per place in the tree
        for text, i in self.vocab.items():
            if not self.sound[i]:
                continue
            path = [byte[c] for c in text.rstrip(END)]
            if text.endswith(END):
                path[-1] += 256
            at = 0
            for letter in path:
                code = at * 512 + letter
                if (at := children.get(code, 0)) == 0:
                    children[code] = at = len(entry)
                    entry.append(-1)
            entry[at] = i
        self.tree = _Table(np.fromiter(children, np.int64, len(children)), np.fromiter(children.values(), np.int64, len(children)))
        self.entry = np.asarray(entry, np.int64)

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, a number above all ranks where it has none."""
        return self.pairs.get(a * self.size + b, len(self.result))

    def stay_apart(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """True where no merge joins the border of the neighbours while they are built. ``inside``: their own merge does not count.

        The merges of both sides are undone from the last one backwards. A pair's merge would have come first if its rank is
        below that of the merge which takes the left symbol on, and not above that of the right one: of equal
        merges the leftmost goes first.
        """
        never = len(self.result)
        fine = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        left_on = np.full(len(a), never)
        right_on = np.full(len(a), never)
        first = inside
        while len(live):
            r = self.merge_rank(a, b)
            clash = (r < never) & (r < left_on) & (r <= right_on) & (not first)
            first = False
            fine[live[clash]] = False
            go = ~clash & ((self.made[a] >= 0) | (self.made[b] >= 0))
            live, a, b, left_on, right_on = live[go], a[go], b[go], left_on[go], right_on[go]
            undo_left = self.made[a] > self.made[b]
            left_on, right_on = np.where(undo_left, self.made[a], left_on), np.where(undo_left, right_on, self.made[b])
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return fine

    def propose(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest sound entries from the left, for all words at once: (word, id) of every token, in order.

        ``letters`` holds all words' letters (0 to 255, at a word's end 256 more), word k those from starts[k] to ends[k].
        """
        word, at, place = np.arange(len(starts)), starts.copy(), np.zeros(len(starts), np.int64)
        best, best_end, ends = np.zeros(len(starts), np.int64), starts.copy(), ends.copy()
        found = []  # (word, start of the token, id)
        begin = starts.copy()
        while len(word):
            inside = at < ends
            place = np.where(inside, self.tree.get(place * 512 + letters[np.minimum(at, len(letters) - 1)], 0), 0)
            going = place > 0
            at = at + 1
            token = np.where(going, self.entry[place], -1)
            best, best_end = np.where(token >= 0, token, best), np.where(token >= 0, at, best_end)
            stop = ~going
            if stop.any():
                found.append((word[stop], begin[stop], best[stop]))
                begin, at = np.where(stop, best_end, begin), np.where(stop, best_end, at)
                left = ~stop | (at < ends)
                word, at, place, best, best_end, ends, begin = (x[left] for x in (word, at, place, best, best_end, ends, begin))
        words, begins, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(begins, kind="stable")  # words lie one after the other
        return words[order], ids[order]

    def merge(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of all words at once, each by its pair of least rank, the leftmost of equal ones: (ids, word)."""
        never = len(self.result)
        rank = np.full(len(ids), never)
        same = np.nonzero(word[1:] == word[:-1])[0]
        rank[same] = self.merge_rank(ids[same], ids[same + 1])
        done = []
        while len(ids):
            starts = np.nonzero(np.r_[True, word[1:] != word[:-1]])[0]
            sizes = np.diff(np.r_[starts, len(ids)])
            least = np.minimum.reduceat(rank, starts)
            over = np.repeat(least == never, sizes)
            if over.any():
                done.append((ids[over], word[over]))
                ids, word, rank, sizes, least = ids[~over], word[~over], rank[~over], sizes[least < never], least[least < never]
                if not len(ids):
                    break
            at = np.nonzero(rank == np.repeat(least, sizes))[0]
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]  # the leftmost of each word
            ids[at] = self.results[least]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at -= np.arange(len(at))  # where the merged pairs stand now
            for i in (at[at > 0] - 1, at):
                paired = np.append(word[1:] == word[:-1], False)[i]
                rank[i] = never
                i = i[paired]
                rank[i] = self.merge_rank(ids[i], ids[i + 1])
        ids, word = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (ids, word)
        order = np.argsort(word, kind="stable")
        return ids[order], word[order]

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same for one word in n log n, by a heap over (rank, place)."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(self.order[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.order]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else len(ids)
            if j >= len(ids) or self.order.get((ids[i], ids[j])) != r:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.result[r], -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for k, m in ((before[i], i), (i, after[i])):
                if k >= 0 and m < len(ids) and (ids[k], ids[m]) in self.order:
                    heapq.heappush(heap, (self.order[ids[k], ids[m]], k))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct normalised words: speculate on all, verify all neighbours together, merge what fails."""
        if not words:
            return []
        coded = [w.encode() for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        ends = np.cumsum(sizes)
        letters = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64)
        letters[ends - 1] += 256
        word, ids = self.propose(letters, ends - sizes, ends)
        border = np.nonzero(word[1:] == word[:-1])[0]
        pairs, at = np.unique(ids[border] * self.size + ids[border + 1], return_inverse=True)
        fails = np.zeros(len(words), bool)
        fails[word[border[~self.stay_apart(pairs // self.size, pairs % self.size)[at]]]] = True
        owner = np.repeat(np.arange(len(words)), sizes)
        short = fails[owner] & (sizes[owner] <= LONG_WORD)
        merged, of = self.merge(self.letters[letters[short]], owner[short])
        kept = ~fails[word]
        ids, word = np.concatenate([ids[kept], merged]), np.concatenate([word[kept], of])
        order = np.argsort(word, kind="stable")
        flat, cuts = ids[order].astype("<u4").tobytes(), np.concatenate([[0], 4 * np.cumsum(np.bincount(word, minlength=len(words)))]).tolist()
        out = [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for k in np.nonzero(fails & (sizes > LONG_WORD))[0].tolist():
            out[k] = np.asarray(self.merge_long(self.letters[letters[ends[k] - sizes[k]:ends[k]]].tolist()), "<u4").tobytes()
        return out

    def _pieces(self, chunk: str) -> list[int | str]:
        """Special ids and normalised words of a stretch without spaces, in order."""
        if chunk.isalpha() and chunk.isascii():
            return [chunk.lower()]
        out: list[int | str] = []
        for k, part in enumerate(self.split.split(chunk) if self.split and "<" in chunk else [chunk]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                part = part.lower() if (plain := part.isascii()) else self.rules.normalize_str(part)
                if part.isalpha():
                    out.append(part)
                else:
                    out += self.ascii_word.findall(part) if plain else [w for w, _ in self.cut.pre_tokenize_str(part)]
        return out

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of stretches not met before, as little-endian bytes; words that occur in several are encoded once."""
        pieces = [self._pieces(c) for c in chunks]
        words = [w for w in dict.fromkeys(chain.from_iterable(pieces)) if w.__class__ is str]
        coded = dict(zip(words, self.encode_words(words), strict=True))
        coded |= {i: pack("<I", i) for i in self.special.values()}
        return {c: coded[ps[0]] if len(ps) == 1 else b"".join(map(coded.__getitem__, ps)) for c, ps in zip(chunks, pieces, strict=True)}

    def _keep(self, found: dict[str, bytes]) -> None:
        self.chunks.update(found)
        self.kept += 160 * len(found) + sum(map(len, found)) + sum(map(len, found.values()))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offsets)."""
        # Neither composition nor the word pattern reaches across a space or a line break.
        parts = [(t or "").replace("\n", " ").split(" ") for t in texts]
        missing = set().union(*parts).difference(self.chunks)
        again = {c: self.older[c] for c in missing.intersection(self.older)}
        fresh = self._learn(list(missing.difference(again)))
        long = {c: fresh.pop(c) for c in [c for c in fresh if len(c) > KEEP_LENGTH]}
        self._keep(again | fresh)
        known = self.chunks | long if long else self.chunks
        coded = [b"".join(map(known.__getitem__, p)) for p in parts]
        if self.kept > REMEMBER // 2:
            self.older, self.chunks, self.kept = self.chunks, {}, 0
        offsets = np.zeros(len(coded) + 1, np.int64)
        np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
        return np.frombuffer(b"".join(coded), "<u4"), offsets

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' own names with a space between, as a tokenizer without a decoder gives them."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= self.size or not self.known[ids].all()):
            wrong = [i for i in np.unique(ids).tolist() if not 0 <= i < self.size or not self.known[i]]
            raise ValueError(f"ids outside the vocabulary: {wrong[:5]}")
        return " ".join(self.names[ids].tolist())


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per tokenizer file and worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _kept(df: DataFrame, keep: tuple[str, ...]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*keep).schema)


def encode(docs: DataFrame, tokenizer: str, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns and ``ids`` (array<int>) of every text."""
    schema = _kept(docs, keep)

    def run(batches):
        own = codec(tokenizer)
        for batch in batches:
            for small in _small(batch):
                ids, offsets = own.encode(small.column(small.num_columns - 1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*small.columns[:-1], lists], names=[*keep, "ids"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema + "ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, *keep: str, ids: str = "ids") -> DataFrame:
    """The kept columns and ``text``, from a column of ids; a NULL array decodes to the empty text."""
    schema = _kept(encoded, keep)

    def run(batches):
        own = codec(tokenizer)
        for batch in batches:
            texts = [own.decode(_ids(x)) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "text"])

    return encoded.select(*keep, F.col(ids).alias("_ids")).mapInArrow(run, schema + "text string")


def _ids(values: list | None) -> np.ndarray:
    if values and None in values:
        raise ValueError("NULL among the ids")
    return np.asarray(values or [], np.int64)


def _small(batch: pa.RecordBatch, size: int = 1 << 22):
    """Slices of a batch of about so many bytes of text, a row at least; the text is the last column."""
    lengths = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(batch.num_columns - 1)])
    start = 0
    while start < batch.num_rows:
        done = lengths[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(lengths, done + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text: key, n_tokens, SHA-256 of its decimal ids and of its decoded text. Encodes and decodes in one pass."""
    schema = _kept(docs, (key,)) + "n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        own = codec(tokenizer)
        decimal = np.asarray([str(i) for i in range(own.size)], object)
        for batch in batches:
            for small in _small(batch):
                ids, offsets = own.encode(small.column(1).to_pylist())
                spans = list(zip(offsets, offsets[1:], strict=False))
                coded = [hashlib.sha256(" ".join(decimal[ids[a:b]].tolist()).encode()).hexdigest() for a, b in spans]
                back = [hashlib.sha256(own.decode(ids[a:b]).encode()).hexdigest() for a, b in spans]
                yield pa.RecordBatch.from_arrays([small.column(0), pa.array(np.diff(offsets)), pa.array(coded, pa.string()), pa.array(back, pa.string())],
                                                 names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every document's ids and decoded text, as digests."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
