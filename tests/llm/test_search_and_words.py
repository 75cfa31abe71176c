"""Token counts, ranked search, spelling variants: against the library and brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import documents, frame
from tokenizers import Tokenizer

from lakestrata.llm import lexical, spelling, tokens
from lakestrata.llm.common import Work


@pytest.fixture(scope="module")
def machine():
    return tokens.Transducer()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def counts(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


# 11 ------------------------------------------------------------------------------------------------------------------

_PARTS = ["a", "b", "s", "'", "'re", "'ll", "'S", " ", "  ", "\n", "\t", "1", "22", "é", "日本", "😀", "!", "--", "<|endoftext|>", "​", "the", " the", "ing",
          "\r\n", "x" * 50, "ÃÂ", "٣", "́", "Ⅷ", "²", "\0", "\x1c", "\x85", "　", "\U0010ffff"]


def test_tokens_equal_the_library(machine, library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(_PARTS, k=rng.randint(0, 60))) for _ in range(3000)] + [None, "", " ", "'", "<|endoftext|>", "<|endoftext|><|endoftext|> a"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(40)) for _ in range(500)]
    assert machine.counts(texts).tolist() == counts(library, texts)


def test_tokens_of_pieces_longer_than_chunks_and_blocks(machine, library, monkeypatch):
    rng = random.Random(2)
    texts = ["y" * 30000, "ab" * 9000, "ÃÂ" * 9000, " " * 20000, "\n" * 5000 + "a", "a'" * 9000, "-=" * 9000, "".join(rng.choices("abcde", k=20000)), "it's  we'll\n " * 3000]
    want = counts(library, texts)
    assert machine.counts(texts).tolist() == want
    for block in (7, 64, 1000):
        monkeypatch.setattr(tokens, "BLOCK", block)
        assert machine.counts([t[:2000] for t in texts]).tolist() == counts(library, [t[:2000] for t in texts])


def test_tokens_start_afresh_when_states_run_out(library):
    small = tokens.Transducer(states=50)
    texts = [r[1] for r in documents()]
    assert [int(small.counts([t])[0]) for t in texts] == counts(library, texts)


def test_tokens_on_awkward_rows(spark, library):
    docs = frame(spark).withColumnsRenamed({"key": "N_Tokens", "part": "n_bytes", "lang": "a.b"})
    got = tokens.counted(docs, limit=20)
    assert got.columns == ["doc_id", "text", "a.b", "source", "n_chars", "size", "score", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r, n in zip(rows, counts(library, [r.text for r in rows])):
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 20)
    assert tokens.counted(frame(spark, [])).count() == 0


# 12 ------------------------------------------------------------------------------------------------------------------

def brute_ranks(docs, items, top):
    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = [(i, Counter(find((t or "").translate(small)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(Counter)
    for i, t in {(i, t) for i, t in items}:
        asked[i].update(find((t or "").translate(small)))
    out = []
    for item, query in asked.items():
        scored = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in query.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("leaf,tree,terms", [(32, 8192, 4096), (1, 8192, 4096), (3, 40, 4096), (2, 64, 30)])
def test_search_by_brute_force(spark, monkeypatch, leaf, tree, terms):
    rows = documents()
    rng = random.Random(leaf)
    texts = [r[1] for r in rows if r[1]]
    items = [(i, " ".join(rng.choice(texts).split()[: rng.randint(1, 60)]).upper()) for i in range(25)]
    items += [items[0], (0, "another text of one"), (90, None), (91, ""), (92, "... --"), (93, "nowhere-found"), (None, items[1][1]), (94, "One one ONE")]
    monkeypatch.setattr(lexical, "BLOCK_TERMS", terms)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = lexical.ranked(frame(spark).repartition(3), asked, 7, leaf, tree).collect()
    assert sorted(repr((r.item_id, r.rank, r.doc_id, r.score)) for r in got) == brute_ranks([(r[0], r[1]) for r in rows], items, 7)


def test_search_of_nothing(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.ranked(none, items).count() == 0
    assert lexical.ranked(frame(spark), items.filter("false")).count() == 0
    assert lexical.ranked(frame(spark), items.selectExpr("item_id", "'qqq' AS text")).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_leaves_subtrees(spark):
    """The bound saves work: leaves that a search of like documents scores are few."""
    rng = np.random.default_rng(3)
    n, size = 4000, 200
    vectors = []
    for _ in range(n):
        codes = np.unique((size * rng.random(12) ** 3).astype(int))
        vectors.append((codes, rng.integers(1, 4, len(codes))))
    grown = lexical.Tree(np.arange(n).astype(object), rng.integers(50, 200, n), vectors, size, 16)
    codes = np.array([3, 150, 170, 190])
    weights = np.array([10, 3000, 3000, 3000])
    dense = np.zeros(size, np.int64)
    dense[codes] = weights
    best = grown.search(codes, weights.astype(float), dense, [], 10)
    exact = sorted(((sum(int(p) * int(dense[c]) for p, c in zip(grown.parts[grown._begin(r): grown.ends[r]], grown.codes[grown._begin(r): grown.ends[r]])), -int(grown.ids[r])) for r in range(n)))[-10:]
    assert [(s, -i) for s, _, _, i in best] == exact
    leaves = sum(not c for c in grown.children)
    kept = (grown.bounds[:, codes] @ weights >= best[0][0]) & np.array([not c for c in grown.children])
    assert kept.sum() < leaves / 2


# 13 ------------------------------------------------------------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_variants(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def vocabulary(seed, n=400):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 9))) for _ in range(n)}
    for w in list(words)[:100]:
        i = rng.randrange(len(w) + 1)
        words |= {w[:i] + w[i + 1 :], w[:i] + "c" + w[i:], w[:i] + "c" + w[i + 1 :]}
    return {w: 5 ** rng.randint(0, 5) + rng.randint(0, 3) for w in words if w}


@pytest.mark.parametrize("hot", [1, 3, 20, 4096])
def test_near_words_by_brute_force(spark, hot):
    counts = vocabulary(hot)
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    got = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(words, Work(spark, "test"), hot).collect()}
    for word in counts:
        found = [v for v in counts if one_edit(word, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)  # ties: the smallest word
        assert got.get(word, (0, None, None)) == (len(found), best, counts.get(best)), word


def test_variants_by_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        base = rng.choices(["therefore", "Therefore", "receive", "straße", "ÉCOLEsÉ", "différents", "separate", "short"], k=60)
        for j in range(0, 60, 9):
            w = base[j]
            base[j] = w[:2] + rng.choice("xyz") + w[3:]
        rows.append((i if i % 50 else None, rng.choice([" ", ", ", "7", "-"]).join(base)))
    rows += [rows[0], (3, None), (4, ""), (None, "12 _ 34")]
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    docs = spark.createDataFrame([(i, t, 5, "w") for i, t in rows], "doc_id long, text string, n int, word string")
    got = sorted(map(tuple, spelling.variants(docs).collect()))
    assert got == brute_variants(counts) and sum(r[1] is not None for r in got) > 10
    assert spelling.variants(frame(spark, [])).count() == 0
    assert spelling.variants(frame(spark)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_roots_follow_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("a", "b")]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(forms, "word string, form string"), Work(spark, "test")).collect()))
    assert got == {**{f"w{i}": "w13" for i in range(13)}, "a": "b"}
