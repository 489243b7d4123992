"""Speculative BPE, the prefix trie and the Merkle manifest against direct versions, on small tables with every odd case."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import merkle_manifest, ordering, prefix_trie, speculative_bpe

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# --- op11 ---------------------------------------------------------------------------------------------------------------

ODD = ("aAbsSΣΟςİıé́̀ñẛ̣Åﬁßİ中文한ᄀ각😀‍​ 　\x1c\x1d\x85᠎\t\n\r'<>|endoftx/w_123²½٣Ⅷःไำ�\x00\x7f#$&\xad ",
       "ab", "lm'", "thein ", "äöü")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@settings(max_examples=300, deadline=None)
@given(text=st.sampled_from(ODD).flatmap(lambda letters: st.text(letters, max_size=90)) | st.text(max_size=40))
def test_codec_gives_the_librarys_ids_and_text(library, text):
    own = speculative_bpe.codec(WORD_BPE)
    ids, offsets = own.encode([text])
    wanted = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == wanted and offsets.tolist() == [0, len(wanted)]
    assert own.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def test_every_character(library):
    """Alone between letters, as Unicode's classes differ from library to library."""
    own = speculative_bpe.Codec(WORD_BPE)
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or not c % 7)]
    ids, offsets = own.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_codec_on_all_entries_joined_at_random(library):
    own, rng = speculative_bpe.Codec(WORD_BPE), random.Random(3)
    entries = [n.replace("</w>", "") for n in own.names[:49406]]
    texts = ["".join(rng.choice(entries) for _ in range(rng.randrange(1, 4))) for _ in range(20000)]
    ids, offsets = own.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def letters(own, word):
    coded = np.frombuffer(word.encode(), np.uint8).astype(int)
    return [*own.letters[coded[:-1]].tolist(), int(own.letters[coded[-1] + 256])]


def test_stay_apart_is_what_merging_says():
    own, rng = speculative_bpe.codec(WORD_BPE), random.Random(4)
    inner = [(t, i) for t, i in own.vocab.items() if t.isascii() and not t.endswith(speculative_bpe.END) and len(t) < 6]
    last = [(t[:-1], i) for t, i in own.vocab.items() if t.isascii() and t.endswith(speculative_bpe.END) and len(t) < 7]
    pairs = [(rng.choice(inner), rng.choice(last)) for _ in range(4000)]
    apart = own.stay_apart(np.asarray([a[1] for a, _ in pairs]), np.asarray([b[1] for _, b in pairs]))
    assert apart.tolist() == [own.merge_long(letters(own, a[0] + b[0])) == [a[1], b[1]] for a, b in pairs]
    assert 0 < apart.sum() < len(pairs)


def test_both_merges_agree():
    own, rng = speculative_bpe.codec(WORD_BPE), random.Random(5)
    words = ["".join(rng.choice(rng.choice(["ab", "a", "thein"])) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    spelled = [letters(own, w) for w in words]
    ids, word = own.merge(np.concatenate(spelled), np.repeat(np.arange(len(words)), [len(x) for x in spelled]))
    assert [ids[word == k].tolist() for k in range(len(words))] == [own.merge_long(x) for x in spelled]


def test_table_of_codes():
    rng = np.random.default_rng(0)
    codes = rng.choice(10**12, 5000, replace=False)
    table = speculative_bpe._Table(codes, np.arange(5000))
    asked = np.concatenate([codes, rng.choice(10**12, 5000)])
    place = {int(c): k for k, c in enumerate(codes)}
    assert table.get(asked, -1).tolist() == [place.get(int(c), -1) for c in asked]


def test_memory_of_words_does_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(speculative_bpe, "REMEMBER", 3000)
    own, rng = speculative_bpe.Codec(WORD_BPE), random.Random(6)
    for _ in range(20):
        texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(400))) + "x" * 500 for _ in range(5)]
        ids, offsets = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert own.kept < 150_000  # what one batch brings


def test_tables_of_texts(spark, library):
    rows = [(0, None), (1, ""), (2, "  \n\t"), (3, "One  two\nTHREE"), (3, "One  two\nTHREE"), (4, "word " * 30000), (5, "a" * 60000), (None, "no id"),
            (6, "x<|endoftext|>y <|startoftext|>"), (7, "naïve Ångström’s")]
    docs = spark.createDataFrame([(i, t, "t", 1, "x") for i, t in rows], "doc_id long, text string, ids string, n_tokens int, _text string")
    coded = {(r["doc_id"], tuple(r["ids"])) for r in speculative_bpe.encode(docs, WORD_BPE, "doc_id").collect()}
    wanted = {(i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows}
    assert coded == wanted
    back = speculative_bpe.decode(speculative_bpe.encode(docs, WORD_BPE, "doc_id"), WORD_BPE, "doc_id").collect()
    assert {(r["doc_id"], r["text"]) for r in back} == {(i, library.decode(list(x), skip_special_tokens=False)) for i, x in wanted}
    got = {r["doc_id"]: r for r in speculative_bpe.digests(docs, WORD_BPE).collect()}
    for i, x in wanted:
        assert got[i]["n_tokens"] == len(x)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(list(x), skip_special_tokens=False).encode()).hexdigest()
    assert speculative_bpe.digests(docs, WORD_BPE).count() == len(rows) and not speculative_bpe.digests(docs.limit(0), WORD_BPE).collect()


@pytest.mark.parametrize("ids", [[5, 49408], [-1], [3, None]])
def test_ids_that_mean_nothing(spark, ids):
    with pytest.raises(PySparkException, match="outside the vocabulary|NULL among the ids"):
        speculative_bpe.decode(spark.createDataFrame([(ids,)], "ids array<int>"), WORD_BPE).collect()


def test_null_ids_decode_to_the_empty_text(spark):
    assert speculative_bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), WORD_BPE).collect() == [("",), ("",)]


# --- numbering ----------------------------------------------------------------------------------------------------------

def test_in_order_numbers_hot_and_equal_keys(spark):
    rng = random.Random(1)
    rows = [(None if rng.random() < 0.1 else 7 if rng.random() < 0.6 else rng.randrange(50), rng.randrange(3)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(ordering.in_order(df, [F.col("a").asc_nulls_first(), F.col("b")]).select("ordinal", "part", "a", "b").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r[0] for r in got] == list(range(4000))
    assert [(r[2], r[3]) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [r[1] for r in got] == sorted(r[1] for r in got)
    assert len({r[1] for r in got if r[2] == 7}) > 1  # a hot key fills more than one range


# --- op12 ---------------------------------------------------------------------------------------------------------------

def trie_by_hand(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            h = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[c].append((turn is not None, turn or 0, h[:30], role, text))
    said = {c: [t[3:] for t in sorted(v)] for c, v in said.items()}
    built = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    sums = {p: [0, 0] for p in members}
    for path, cs in members.items():
        saved = (len(cs) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            sums[path[:d]][0] += path not in children
            sums[path[:d]][1] += saved
    return {(min(cs), len(p)): (min(members[p[:-1]]) if p else None, len(cs), len(children[p]) if p in children else 0, *sums[p],
            hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p)).encode()).hexdigest()) for p, cs in members.items()}


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, p1 string")
    got = prefix_trie.trie(prefix_trie.rebuilt(*prefix_trie.numbered(df))).collect()
    out = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in got}
    assert len(out) == len(got)
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["hi", "yes", "nö", "", None])) for c in [*range(40), *range(100, 160), *range(305, 330)]
            for t in range(rng.randrange(1, 9))]
    rows += [(200, t, "user", f"turn {t % 7}") for t in range(90)] + [(c, t, "user", f"turn {t % 7}") for c in (201, 207, 230) for t in range(70 + c % 5)]
    rows += [(-105, t, "a", "neg") for t in range(7)] + [(-100, t, "a", "base") for t in range(7)]
    rows += [(400, None, "a", "first"), (400, 0, "a", "second"), (401, 3, "b", "same"), (401, 3, "b", "same"), (402, 5, "b", "x"), (402, 5, "c", "y")]
    rows += [(None, 0, "user", "nobody"), (None, 1, "user", "said")] + [(c, t, "user", "ab"[t % 2] * 3000) for c in (500, 501, 502) for t in range(4)]
    rng.shuffle(rows)
    return rows


def test_trie(spark, talks):
    assert trie_of(spark, talks) == trie_by_hand(talks)


def test_trie_with_low_bands_and_short_stretches(spark, talks, monkeypatch):
    """Many bands and blocks: several rounds of the roll-up, carries between blocks, stretches that follow each other."""
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    monkeypatch.setattr(prefix_trie, "BLOCK", 6)
    monkeypatch.setattr(prefix_trie, "STRETCH", 1)
    monkeypatch.setattr(prefix_trie, "BUCKETS", 4)
    assert trie_of(spark, talks) == trie_by_hand(talks)


def test_trie_of_copies(spark):
    rows = [(c, t, "user", f"q{t}") for c in range(1000, 1400) for t in range(7)]
    assert trie_of(spark, rows) == trie_by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "a", "b")], [(17, 0, None, None)]])
def test_tiny_tries(spark, rows):
    assert trie_of(spark, rows) == trie_by_hand(rows)


# --- op13 ---------------------------------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_by_hand(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def manifest_by_hand(rows):
    groups = defaultdict(list)
    for doc, source, lang, n, text in rows:
        bad = text.replace("\n", "") if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0 else text
        groups[source].append((doc is not None, doc or 0, leaf_by_hand((doc, source, lang, n, text)), leaf_by_hand((doc, source, lang, n, bad)), doc))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels_by_hand([r[2] for r in sorted(groups[s])]) for s in names]
    upper = levels_by_hand([t[-1][0] for t in trees])
    out = []
    for g, s in enumerate(names):
        for k, (_, _, leaf, claim, doc) in enumerate(sorted(groups[s])):
            proof, folded = "", claim
            for levels, at in ((trees[g], k), (upper, g)):
                for level in levels[:-1]:
                    run, i = at // 3 * 3, at % 3
                    before, after = "".join(level[run:run + i]), "".join(level[run + i + 1:run + 3])
                    proof, folded, at = proof + before + after, sha(before, folded, after), at // 3
            out.append((doc, leaf, trees[g][-1][0], upper[-1][0], sha(proof), folded, folded == upper[-1][0]))
    return out


def manifest_of(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, leaf string, ordinal int, tree string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in merkle_manifest.query(spark, str(tmp_path)).collect()]


def order(rows):
    return sorted(rows, key=str)


def documents(n, rng, sources):
    return [(rng.randrange(n), rng.choice(sources), rng.choice(["de", None]), rng.choice([1, None]), rng.choice(["a\nb", "ab", "", None, "ü\n\n"])) for _ in range(n)]


def test_manifest(spark, tmp_path):
    rng = random.Random(2)
    rows = documents(700, rng, [None, "", "hot", "hot", "hot", "é", "z", "Z"]) + [(None, "hot", None, None, None)] * 2 + [(k, f"s{k}", "x", 3, "l\n") for k in range(60)]
    rows += [(9000, "lone", "en", 5, "a\nb"), (9001, "hot", "en", 100_000, "long\n" * 20_000)] + [rows[3]] * 5
    assert order(manifest_of(spark, rows, tmp_path)) == order(manifest_by_hand(rows))


def test_manifest_with_small_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "BLOCK", merkle_manifest.WIDE)
    rng = random.Random(3)
    rows = documents(300, rng, ["a", "b", None, "a"])
    assert order(manifest_of(spark, rows, tmp_path)) == order(manifest_by_hand(rows))


@pytest.mark.parametrize("rows", [[], [(1, "s", "l", 2, "a\nb")], [(1, None, None, None, None), (2, None, None, None, "\n")], [(k, str(k), "", 0, "x") for k in range(4)]])
def test_tiny_manifests(spark, tmp_path, rows):
    assert order(manifest_of(spark, rows, tmp_path)) == order(manifest_by_hand(rows))


def test_climb_goes_beyond_the_sessions_row_limit(spark, tmp_path):
    """The recursive query's row limit is lifted for the climb alone."""
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "50")
    try:
        rows = documents(200, random.Random(4), ["a"])
        assert order(manifest_of(spark, rows, tmp_path)) == order(manifest_by_hand(rows))
        assert spark.conf.get(limit) == "50"
    finally:
        spark.conf.set(limit, before)
