"""Cross-tokenizer alignment, divergence of sources and exact search, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandlake.llm import alignment, divergence, topk

public_tokenizers = pytest.importorskip("public_tokenizers")
PATHS = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def sides():
    return alignment._Sides(*(open(p, "rb").read() for p in PATHS))


def _plain(sides, text):
    """Groups of one text as lists of ids, found by a walk over both sides."""
    a, b = sides.a.encode_batch([" " + text], add_special_tokens=False)[0].ids, sides.b.encode(text)
    spelled = [[t[i] for i in x] for t, x in zip(sides.bytes, (a, b))]
    if any(b"".join(x) != (" " + text).encode() for x in spelled):
        return None
    groups, i, j = [], 0, 0
    while i < len(a):
        x, y, p, q = [a[i]], [b[j]], len(spelled[0][i]), len(spelled[1][j])
        while p != q:
            if p < q:
                i += 1
                x.append(a[i])
                p += len(spelled[0][i])
            else:
                j += 1
                y.append(b[j])
                q += len(spelled[1][j])
        groups.append((x, y))
        i, j = i + 1, j + 1
    return groups


def _want(sides, texts):
    found = [_plain(sides, t) if t else None for t in texts]
    links = [Counter((a, b) for x, y in g or () for a in x for b in y) for g in found]
    counts = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for g, c in zip(found, links):
        if not g:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), c.total(), sum(n for p, n in c.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in c.items()), hashlib.sha256(said.encode()).hexdigest()))
    return out


ODD = [
    None, "", " ", "  ", "\n", " \n ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "x  y", "y  z", "naïve café　日本 語", "don't  stop", "<|endoftext|> and <s> </s> <unk>", "<0x41>", "▁ low ▁line▁", "\x00\x01", "é" * 40, "🙂 🙃🙂",
    "\t\tx", "1234567890" * 5, "ﬁ ligature", "é", "﻿bom", "\x1c x", "a\x85 b", "​ zero", "ẞtraße  \r\n end", "--==--  ==--", "http://a.b/c?d=e&f#g", "_" * 70, " " * 70, "x" + " " * 33 + "y",
]


def test_alignment_by_brute_force(spark, sides):
    r = random.Random(11)
    words = ["the", "Straße", "naïve", "x1y2", "don't", "\n", "\tfoo", "", "日本", "🙂", "unbelievable", "...", "qzxv"]
    texts = [*ODD, *(r.choice([" ", " ", "  ", "\n"]).join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(40))]
    texts += [texts[-1], texts[-1]]
    docs = spark.createDataFrame([(k if k % 9 else None, t, k, "clash") for k, t in enumerate(texts)], "doc_id long, text string, row int, pairs string")
    want = _want(sides, texts)
    for hot in (1 << 18, 40, 0):
        got = alignment.aligned(docs, *PATHS, hot=hot).collect()
        assert sorted((str(x[0]), *x[1:]) for x in got) == sorted((str(k if k % 9 else None), *w) for k, w in enumerate(want))
    assert sum(w[0] > 0 for w in want) > 60 and any(t and not w[0] for t, w in zip(texts, want))
    assert alignment.aligned(docs.limit(0), *PATHS).count() == 0


def test_alignment_of_long_texts_in_parts(sides, monkeypatch):
    r = random.Random(3)
    text = " ".join(r.choice(["alpha", "bétä", "c\nd", "", "  ", "42", "qwertzuiopasdfgh"]) for _ in range(4000))
    whole = [x.values() for x in alignment._aligned(sides, alignment._Table(sides), [text])][0]
    monkeypatch.setattr(alignment, "PART", 500)
    monkeypatch.setattr(alignment, "BATCH", 1200)
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "LARGE", 2)
    cut = [x.values() for x in alignment._aligned(sides, alignment._Table(sides), ["x", text, None, text])]
    assert cut[1][:5] == cut[3][:5] == whole[:5] == (*_want(sides, [text])[0][:4], _want(sides, [text])[0][6])
    assert [x.tolist() for x in alignment.unpacked(cut[1][5])] == [x.tolist() for x in alignment.unpacked(whole[5])]
    assert len(list(alignment.parts("a " * 1000, 500))) == 4 and "".join(alignment.parts("ab" * 1000, 500)) == "ab" * 1000


def test_a_group_of_very_many_links():
    """Tokens that meet only at the end: pairs are counted by id, not listed one by one."""

    class Sides:
        sizes = (np.array([3, 3]), np.array([7, 7]))
        names, most = [f"{i}{c}" for c in ",|;" for i in range(2)], 2

    n = 1000  # groups of seven tokens of three bytes and three of seven
    ids = [np.arange(7 * n) % 2, np.arange(3 * n) % 2]
    first = alignment.Batch(Sides, [ids[0][:7], ids[1][:3]], [np.array([7]), np.array([3])])
    assert first.n_groups.tolist() == [1] and first.n_links.tolist() == [21] and first.text == ["0,1,0,1,0,1,0|0,1,0"]
    i, j = alignment.overlaps(np.zeros(7 * n, int), np.arange(7 * n) * 3, np.zeros(3 * n, int), np.arange(3 * n) * 7)
    assert len(set(zip(i.tolist(), j.tolist()))) == 9 * n
    Sides.sizes = (np.array([1, 2]), np.array([2, 2]))
    a, b = np.array([0] + [1] * 6_000 + [0]), np.arange(6_001) % 2  # a byte off until the end
    found = alignment.Batch(Sides, [a, b], [np.array([len(a)]), np.array([len(b)])])
    assert found.n_groups.tolist() == [1] and found.n_links.tolist() == [len(a) * len(b)]
    keys, links = found.pairs[0]
    assert len(keys) == 4 and links.sum() == len(a) * len(b)


def _audit(rows, least, most):
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", Counter(word.findall((text or "").translate(lower)))) for text, lang, source in rows]
    out = []
    for lang in {x for x, _, _ in docs}:
        own = [(s, c) for x, s, c in docs if x == lang]
        df = Counter(t for _, c in own for t in c)
        kept = sorted((t for t, n in df.items() if n >= least), key=str.encode)
        count = {s: Counter() for s, _ in own}
        for s, c in own:
            count[s].update({t: n for t, n in c.items() if t in set(kept)})
        everywhere = sum(count.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (c.total() + 2 * len(kept))

        def differ(p, q):
            return (p - q) ** 2 // (p + q)

        for s in count:
            pairs = [(-sum(differ(share(count[s], t), share(count[o], t)) for t in kept), o.encode()) for o in count if o != s]
            terms = [(-differ(share(count[s], t), share(everywhere, t)), t.encode()) for t in kept if count[s][t] and share(count[s], t) > share(everywhere, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "words", "sources"), [(3, 4096, 128), (3, 7, 2), (1, 5, 3), (50, 5, 1)])
def test_divergence_by_brute_force(spark, least, words, sources):
    r = random.Random(least + words)
    vocabulary = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["Éa", "éa", "ß", "日本", " x", "I"]
    rows = []
    for _ in range(160):
        text = r.choice([" ", "\n", "-", "0"]).join(r.choice(vocabulary[: r.choice([5, 30, 66])]).title() for _ in range(r.randint(0, 30)))
        rows.append((text, r.choice(["en", "en", "en", "de", None, ""]), r.choice(["hot"] * 5 + ["a", "b", "ß", None, ""])))
    rows += [(None, "only", "x"), ("", "only", "y"), (None, "alone", "z"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*x, "c", 1) for x in rows], "text string, lang string, source string, term string, place int")
    got = divergence.audited(docs, least_docs=least, words=words, sources=sources).collect()
    assert sorted(map(tuple, got)) == _audit(rows, least, 10)
    assert divergence.audited(docs.limit(0)).count() == 0


def test_words_of_a_very_long_text(monkeypatch):
    text = (" Äpfel,Birnen0Äpfel" * 5000).encode()
    want = divergence.frequencies(text)
    monkeypatch.setattr(divergence, "PIECE", 100)
    assert divergence.frequencies(text) == want == {"Äpfel".encode(): 10_000, b"birnen": 5000}
    assert divergence.frequencies(b"x" * 5000) == {b"x" * 5000: 1}


def test_shares_of_very_large_counts():
    n, total = np.array([10**12, 0]), np.array([3 * 10**12, 3 * 10**12])
    assert divergence._shares(n, total).tolist() == [1 + 10**9 * (int(x) + 2) // int(t) for x, t in zip(n, total)]


def _top(rows, every, k):
    fine = [(i, [float(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({(q, tuple(v)) for q, v in fine if q % every == 0}):
        scored = sorted((-sum(int(x) * int(y) for x, y in zip(v, w)), i) for i, w in fine if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("tile", "dense"), [(1 << 13, 0.25), (16, 0.25), (40, 1.1), (40, 0.0)])
def test_search_by_brute_force(spark, tile, dense, monkeypatch):
    monkeypatch.setattr(topk, "DENSE", dense)
    r = random.Random(tile)
    rows = [(k, [r.choice([0.0, 0.0, 0.001, r.uniform(-1, 1)]) for _ in range(12)]) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(40)] + [rows[9]] * 8 + [rows[0], (None, rows[1][1]), (1000, None), (1050, [0.1] * 11 + [None]), (1100, [0.1] * 11 + [float("nan")]), (1150, [float("inf")] * 12), (1200, []), (1250, [1.0] * 5), (1300, [0.5] * 20)]
    docs = spark.createDataFrame([(*x, 1, "c") for x in rows], "vec_id long, embedding array<float>, tile int, copies string")
    got = topk.searched(docs, every=50, k=5, tile=tile).collect()
    single = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in rows]
    assert sorted(map(tuple, got)) == _top(single, 50, 5)
    assert topk.searched(docs.limit(0)).count() == 0 and topk.searched(docs.limit(1), k=5).count() == 0


def test_search_of_huge_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, -1.0]), (2, [-1e30, 0.0]), (3, [3e14, 7.0]), (50, [2e-45, 5e9])]
    got = topk.searched(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=9).collect()
    exact = [(i, [int(np.floor(256 * x)) if abs(x) < 1e13 else 256 * int(x) for x in v]) for i, v in rows]
    want = []
    for q in (0, 50):
        scored = sorted((-sum(x * y for x, y in zip(exact[0 if q == 0 else 4][1], w)), i) for i, w in exact if i != q)
        want += [(q, n, i, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, i) in enumerate(scored, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_the_registered_alignment_by_brute_force(spark, sides):
    import os

    from strandlake.llm import queries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: w for r, w in zip(docs, _want(sides, [r["text"] for r in docs]))}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_alignment(spark, sf).collect()}
    assert got == want
