"""Every operator against a brute-force version, on small tables with NULLs, empty and long texts, ties, repeats and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import (
    components, fingerprints, jaccard_join, licences, main_text, packing, personal_data, piece_transducer, quality_model, quality_rules, repeats)
from tidemark.llm.run_index import RunIndex, covered

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside, as further columns of the input.
CLASH = ["sig", "key", "count", "tid", "spans", "n_words", "_t", "bucket", "email", "token"]


def table(spark, rows):
    """doc_id, text and columns with clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(i, t, None, None if i is None else "hot", None, *["x"] * len(CLASH)) for i, t in rows], schema)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = prose(rng, 120)
    passage = prose(rng, 60)
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "one two"), (5, "One TWO"), (6, base), (7, base), (7, base), (8, base.replace(" ", "  ", 3)),
            (9, base + " tail"), (10, "Und " * 400), (11, prose(rng, 9000)), (12, prose(rng, 80) + " " + passage + " " + prose(rng, 70)),
            (13, prose(rng, 90) + "\n" + passage + "\n" + prose(rng, 50)), (14, "".join(rng.choice("éèü") for _ in range(150)) + passage[:230]), (None, prose(rng, 70)), (15, "line\nline\nline\n" * 30)]
    for k in range(30):  # a dense family: every member a few edits from the base
        w = base.split(" ")
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = prose(rng, 1) + "q"
        rows.append((100 + k, " ".join(w)))
    return rows


def lowered(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def grams(text, size):
    w = lowered(text)
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def groups(rows, size, percent):
    """Component of each row, by all pairs."""
    sets = [grams(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sets, [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("dense,block", [(16, 512), (3, 8)])
def test_jaccard_join(spark, texts, monkeypatch, dense, block):
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    got = Counter(map(tuple, jaccard_join.link(table(spark, texts)).collect()))
    sets, root = groups(texts, 3, 90)
    want = Counter()
    for (i, _), s, r in zip(texts, sets, root):
        ids = [k for (k, _), q in zip(texts, root) if q == r and k is not None]
        want[(i, len(s), (min(ids) if ids else None) if s else i)] += 1
    assert got == want


def test_jaccard_deduplicate(spark, texts):
    docs = table(spark, texts)
    got = jaccard_join.deduplicate(docs)
    assert got.columns == docs.columns
    sets, root = groups(texts, 5, 80)
    want = []
    for r in set(root):
        members = [(i is None, i or 0, i, t) for (i, t), q, s in zip(texts, root, sets) if q == r and s]
        want += [min(members)[2]] if members else [i for (i, _), q in zip(texts, root) if q == r]
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(want)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 130)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {n: r for n, r in label.items() if any(n in e and e[0] != e[1] for e in edges)}


def brute_repeats(texts):
    raws = [(t or "").encode() for _, t in texts]
    count = Counter(b[i:i + 200] for b in raws for i in range(len(b) - 199))
    out = []
    for (doc, _), b in zip(texts, raws):
        spans = covered(*(np.array(x, np.int64) for x in zip(*[(i, i + 200) for i in range(len(b) - 199) if count[b[i:i + 200]] > 1]))) if any(
            count[b[i:i + 200]] > 1 for i in range(len(b) - 199)) else []
        kept = b"".join(b[a:z] for a, z in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(b)]))
        out.append((doc, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeats(spark, texts, crowd):
    assert Counter(map(tuple, repeats.report(table(spark, texts), crowd=crowd).collect())) == brute_repeats(texts)


def test_repeats_remove(spark, texts):
    docs = table(spark, texts)
    got = repeats.remove(docs)
    assert got.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in got.collect()}
    assert 6 not in left and 7 not in left and left[1] == "" and left[0] is None and left[3] == "one"
    assert len(left[14]) == 150 and set(left[14]) == set("éèü")


def test_run_index_marks_every_repeated_window():
    rng = random.Random(3)
    for _ in range(60):
        depth, letters = rng.choice([16, 17, 31]), rng.choice([1, 2, 20])
        strings = [bytes(rng.randrange(letters) + 97 for _ in range(rng.randrange(0, 90))) for _ in range(6)]
        strings += [strings[0][3:] + b"z", b"xy" * 30]
        count = Counter(s[i:i + depth] for s in strings for i in range(len(s) - depth + 1))
        owner, start, length = RunIndex(strings, depth).matches()
        for k, s in enumerate(strings):
            want = [i for i in range(len(s) - depth + 1) if count[s[i:i + depth]] > 1]
            assert covered(start[owner == k], (start + length)[owner == k]) == covered(np.array(want, np.int64), np.array(want, np.int64) + depth)


PERSONAL = [
    (1, "Mail a.b%c@ex-1.example.org, x@y@z.co_d@e.fg or a@b..c now"), (2, "ip 1.2.3.4.5 and 300.1.1.1 and 010.0.0.255 end 8.8.8.8"),
    (3, "card 4539 1488 0343 6467 and 4539-1488-0343-6468, 4111111111111111 1"), (4, "call +1 (743) 555-3824. or +49 30 1 or +123456789012345678"),
    (5, None), (6, ""), (7, "é" * 5 + " +33 1 23 45 67 89 token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\""), (8, "9" * 3000 + "." * 50 + "a" * 4000), (8, "a@b.cc"), (None, "a@b.cc"),
]
BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
}


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(s))) % 10 == 0


def brute_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in BASE.items() for m in re.finditer(p, text or "") if ok(m.group(0))]


def test_personal_data(spark):
    docs = table(spark, PERSONAL)
    model = personal_data.boost([((0, 4, 3, 4, 0, 0, 1, 1), 1, p, 50) for p in (0, 1)] + [((0, 0, 4, 0, 0, 0, 0, 1), 0, p, 500) for p in (0, 1)])
    rows = personal_data.add_spans(docs.withColumnRenamed("text", "_x").selectExpr("doc_id", "coalesce(_x, '') as body"), "body", model).collect()
    by_text = {r["body"]: r for r in rows}
    for _, text in PERSONAL:
        r = by_text[text or ""]
        assert [f"{k}:{s['start']}:{s['end']}" for k in personal_data.KINDS for s in r[k]] == brute_spans(text)
    assert [m["kind"] for m in by_text[PERSONAL[6][1]]["_more"]] == ["secret"]
    clean = personal_data.redact(docs, model)
    assert clean.columns == docs.columns and clean.count() == len(PERSONAL)
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert text[7] == "éééée [PHONE] token = \"[SECRET]\"".replace("éééée", "é" * 5) and text[5] is None and text[6] == ""
    assert personal_data.learn(docs.limit(0)).accepts() == "false"


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{k}@ex{k}.org" for k in range(700))
    row = personal_data.add_base(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert [f"email:{s['start']}:{s['end']}" for s in row["email"]] == [x for x in brute_spans(text) if x.startswith("email")]


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = texts + [(500, "don't. 'S Éa, ÜBER straße é ΑΣ 1,2 a1 <|endoftext|> x|. \x1c\xa0y"), (501, "漢字 " * 3000)]
    tokenizer = Tokenizer.from_file(path)
    want = {t or "": np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in rows}
    cut = packing.pieces(table(spark, rows), path, with_ids=True)
    got = packing.pack(cut, len(rows)).toPandas()
    assert Counter(got.groupby("doc_id", dropna=False)["length"].sum().to_dict().values()) == Counter(
        {k: sum(len(want[t or ""]) for i, t in rows if i == k) for k in {i for i, _ in rows}}.values())
    for r in got.itertuples():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        assert any(want[t or ""][r.start:r.start + r.length].tobytes() == r.ids and len(want[t or ""]) == r.doc_tokens for i, t in rows)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= 4096
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packing.pack(cut, len(rows))).collect()}
    first = got[got["sequence_id"] == got["sequence_id"].iloc[0]].sort_values("offset")
    assert whole[got["sequence_id"].iloc[0]] == np.frombuffer(b"".join(first["ids"]), "<u4").tolist()


def test_best_fit_takes_the_tightest_room():
    rng = np.random.default_rng(0)
    for capacity in (1, 2, 7, 8, 100):
        lengths = np.sort(rng.integers(1, capacity + 1, 90))[::-1]
        sequence, offset = packing.best_fit(lengths, capacity)
        rooms = []
        for n in lengths.tolist():
            fit = min((r for r in rooms if r >= n), default=capacity)
            if fit in rooms:
                rooms.remove(fit)
            rooms.append(fit - n)
        used = np.bincount(sequence, lengths)
        assert sorted(capacity - used) == sorted(rooms) and all(offset + lengths <= capacity)


def test_quality_rules(spark, texts):
    rows = texts + [(900, "a*** b%%% " * 40), (901, "x")]
    got = {(r["doc_id"], r["n_words"]): r for r in quality_rules.ledger(table(spark, rows)).collect()}
    for i, t in rows:
        w = WORDS.findall(t or "")
        seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        inside = {p for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for p in range(k, k + 3)}
        lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
        r = got[i, len(w)]
        assert (r["n_repeat_words"], r["word_chars"], r["n_dup_lines"], r["n_symbols"]) == (
            len(inside), sum(map(len, w)), len(lines) - len(set(lines)), sum(c in "#*$%&|<>" for c in t or ""))
    docs = table(spark, rows)
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        r["doc_id"] for r in quality_rules.ledger(docs).filter(quality_rules.verdict("v1")).collect())
    effect = {r["rule"]: r for r in quality_rules.ablation(quality_rules.ledger(docs), "v1").collect()}
    assert effect["symbols"]["n_failed"] == 1 and effect["few_words"]["n_only"] > 0


def test_fingerprints(spark, texts):
    rows = [(i, t) for i, t in texts]
    docs = table(spark, rows).selectExpr("doc_id", "coalesce(text, '') as text")
    got = fingerprints.with_next(fingerprints.add_sketch(docs, "text", "own"), "doc_id", ["text"], ["text"]).collect()
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    follow = Counter((a[2], b[2]) for a, b in zip(order, order[1:] + order[:1]))
    assert Counter((r["text"], r["next_text"]) for r in got) == follow
    for r in got:
        w = WORDS.findall(r["text"])
        h = {hashlib.md5(" ".join(w[k:k + 5]).encode()).hexdigest() for k in range(max(1, len(w) - 4))} if w else set()
        assert r["own"] == sorted({x[:16] for x in h if x < "2"} or ({min(h)[:16]} if h else set()))


def test_fingerprints_over_many_ranges(spark):
    ids = [0, 3, 700, 701, 5000, 5001, 90_000]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(docs, "doc_id", ["text"], ["text"]).collect()}
    assert got == {a: f"t{b}" for a, b in zip(ids, ids[1:] + ids[:1])}


def test_quality_model(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, 60) if k % 2 else " ".join(w.upper() + "!!" for w in prose(rng, 40).split())) for k in range(160)]
    docs = table(spark, rows + [(None, "x"), (1000, None), (1001, "")])
    labels = spark.createDataFrame([(k, k % 2) for k in range(160)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality_model.learn(docs, labels)
    got = quality_model.score(docs, model).collect()
    assert len(got) == 163 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 160 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert held and all((r["score"] >= 0.5) == r["doc_id"] % 2 for r in held)
    none = quality_model.score(docs, quality_model.learn(docs, labels.limit(0))).collect()
    assert {r["score"] for r in none} == {0.5}


def test_piece_transducer(spark, texts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    other = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = texts + [(600, "  a  b\nc\t 漢字 😀 <s> <0x41> ▁a\r\n\n x"), (601, " ")]
    got = piece_transducer.round_trip(table(spark, rows), path).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((i, tuple(other.encode(t or ""))) for i, t in rows)
    assert all(r["decodes"] for r in got if r["doc_id"] != 600)  # a mark in the text reads as a space


PAGE = ("<html><head><title>t</title></head><body><nav><ul><li>Home</li></ul></nav>{extra}<{tag}><h1>Title {k}</h1><p>Para &amp; one <b>bold</b> {k}.<p>Two\n  {k}"
        "<div class='comments'>reader</div></{tag}><script>if(a<b)'</p>'</script><footer>&copy; x</footer></body></html>")


@pytest.mark.parametrize(("html", "text"), [
    ('<article><h1 class="article-header">Head</h1><p>Body', "Head Body"),
    ('<article><div class="content with-sidebar"><p>Body</p></div></article>', "Body"),
    ('<article><p class="share">tell all<p>Body</article>', "Body"),
    ('<article><p class="share">tell <b>all</b></p><p>Body</p></article>', "Body"),
    ('<article><div class="sidebar main-sidebar">x</div><p>Body</p></article>', "Body"),
    ('<article><p>One</p><div class="post-comments"><p>no</div><p>Two</article>', "One Two"),
])
def test_what_names_say(html, text):
    marked, found = main_text.blocks(html)
    assert marked and " ".join(t for zone, t in found if zone == main_text.INSIDE) == text


def test_unique_tokens_against_a_direct_version():
    rng = np.random.default_rng(3)
    for _ in range(300):
        sizes = rng.integers(1, 20, rng.integers(1, 8))
        n, open_ = int(sizes.sum()), rng.random(len(sizes)) < 0.8
        starts = np.flatnonzero(rng.random(max(0, n - main_text.RUN + 1)) < 0.25)
        block = np.repeat(np.arange(len(sizes)), sizes)
        over = {p for s in starts for p in range(s, s + main_text.RUN)}
        inside = {p for s in starts if block[s] == block[s + main_text.RUN - 1] for p in range(s, s + main_text.RUN)}
        want = [open_[block[p]] and p not in inside and not all(q in over for q in np.flatnonzero(block == block[p])) for p in range(n)]
        assert main_text._unique(starts, sizes, open_).tolist() == want


def test_main_text(spark):
    notice = "<div>we use small files to make this site work better for all of you</div>"
    rows = [(k, f"https://h.example/{k}", PAGE.format(k=k, tag="article", extra=notice)) for k in range(3)]
    rows += [(10 + k, f"https://h.example/p{k}", PAGE.format(k=k, tag="div", extra=notice)) for k in range(3)]
    rows += [(20, "https://other.example/", PAGE.format(k=9, tag="div", extra=notice)), (30, None, None), (31, "u", ""), (32, "u", "plain &lt;words&gt;"), (32, "u", "plain &lt;words&gt;"),
             (33, "https://x/", "<article><p>cut &am")]
    got = {r["page_id"]: r["text"] for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == got[10 + k] == f"Title {k} Para & one bold {k}. Two {k}" for k in range(3))
    assert main_text.extract(spark.createDataFrame(rows[:0] or [], "page_id long, url string, html string")).collect() == []
    assert got[20].startswith("we use small files") and got[30] == got[31] == "" and got[32] == "plain <words>" and got[33] == "cut &am"
    assert main_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_main_text_frame_decides_inside_marked_articles(spark):
    rng = random.Random(4)
    notice, shared = prose(rng, 14), prose(rng, 14)
    body = {k: prose(rng, 30) for k in range(4)}
    page = "<body><{tag} class='x1'><p>{extra}</p></{tag}><article><h1>Title {k}</h1><p>{a}</p><div class='x1'>{mid}</div><p>{b}</p></article></body>"
    rows = [(k, f"https://h.example/{k}", page.format(tag="div", extra=prose(rng, 12), k=k, a=body[k], mid=notice, b=shared)) for k in range(3)]
    rows += [(10 + k, f"https://h.example/f{k}", page.format(tag="footer", extra=notice, k=f"f{k}", a=prose(rng, 20), mid="own", b="end")) for k in range(2)]
    # A copy of an article at another place, and teasers of it on two pages.
    rows += [(20 + k, f"https://h.example/c{k}", page.format(tag="div", extra="top", k=9, a=body[3], mid="own", b="end")) for k in range(2)]
    rows += [(30 + k, f"https://h.example/t{k}", page.format(tag="aside", extra=body[3], k=f"t{k}", a="short", mid="own", b="end")) for k in range(2)]
    # A paragraph of two articles that the frame quotes.
    rows += [(50 + k, f"https://h.example/q{k}", page.format(tag="aside", extra="top", k=f"q{k}", a=body[3], mid="own", b="end")) for k in range(2)]
    # The frame of one host says nothing about another.
    rows += [(40, "https://other.example/", page.format(tag="div", extra="top", k=40, a="short", mid=notice, b="end")), (0, *rows[0][1:])]
    got = [tuple(r) for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).select("page_id", "text").collect()]
    text = dict(got)
    assert len(got) == len(rows) and [i for i, _ in got].count(0) == 2
    assert all(text[k] == f"Title {k} {body[k]} {shared}" for k in range(3))
    assert text[20] == text[21] == f"Title 9 {body[3]} own end" and text[50] == f"Title q0 {body[3]} own end" and text[40] == f"Title 40 short {notice} end"


def runs_of(streams):
    return {(page, p): tuple(w[p:p + main_text.RUN]) for page, w in streams for p in range(len(w) - main_text.RUN + 1)}


def test_frame_against_a_direct_version(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abc") for _ in range(rng.randrange(3, 14))) for _ in range(9)]
    rows, outside, inside, plain = [], [], [], set()
    for k in range(60):
        top, own = rng.sample(pool, 2), rng.sample(pool, 3)
        marked, site = rng.random() < 0.6, f"h{k % 2}.example"
        tag = "article" if marked else "section"
        row = (k, f"https://{site}/{k}", f"<p>{top[0]}</p><nav>{top[1]}</nav><{tag}>" + "".join(f"<p>{x}</p>" for x in own) + f"</{tag}>")
        rows.append(row)
        page = main_text._number(*row[1:])
        outside.append((site, page, " ".join(top if marked else top + own).split(), None))
        inside += [(site, page, " ".join(own).split(), own[0])] if marked else []
        plain |= set() if marked else {page}
    want = set()
    for site in ("h0.example", "h1.example"):
        pages, firsts = defaultdict(set), defaultdict(set)
        for (page, _), run in runs_of([x[1:3] for x in outside if x[0] == site]).items():
            pages[run].add(page)
        for x in inside:
            for run in runs_of([x[1:3]]).values() if x[0] == site else ():
                firsts[run].add(x[3])
        want |= {at for at, run in runs_of([x[1:3] for x in outside if x[0] == site and x[1] in plain]).items() if len(pages[run]) > 1}
        want |= {at for at, run in runs_of([x[1:3] for x in inside if x[0] == site]).items() if len(pages[run]) > 1 and len(firsts[run]) > 1}
    found = main_text.frame_starts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {(r["page"], p) for r in found for p in r["starts"]}
    assert got == want and any(page in plain for page, _ in want) and any(page not in plain for page, _ in want)


def test_licences(spark):
    full = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")
    rows = [(1, "Text.\nReleased under the MIT License."), (2, full), (3, None), (4, ""), (5, "no such thing"), (6, "All rights reserved.\nLicensed under the Apache License, Version 2.0."), (6, "licence")]
    got = Counter((r["doc_id"], r["licences"]) for r in licences.scan(table(spark, rows)).collect())
    assert got == Counter([(1, "mit"), (2, "mit"), (3, ""), (4, ""), (5, ""), (6, "apache-2.0,proprietary"), (6, "")])


def test_empty_tables(spark):
    docs = table(spark, []).repartition(2)
    path = public_tokenizers.path("word_bpe_49k.json")
    frames = [jaccard_join.link(docs), jaccard_join.deduplicate(docs), repeats.report(docs), repeats.remove(docs), packing.run(docs, path), quality_rules.ledger(docs), licences.scan(docs),
              personal_data.redact(docs, personal_data.learn(docs)), fingerprints.with_next(docs.select("doc_id", "text"), "doc_id", ["text"], ["text"]),
              piece_transducer.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))]
    assert [f.count() for f in frames] == [0] * len(frames)
