"""Operators on documents: edge cases, and brute force where SQL can't say it."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from cases import SCHEMA, documents, frame, lower, listing, luhn, personal, roots, secret, words

import corpus_pipeline
from lakestrata.llm import ledger, licenses, minhash, mixing, packing, pii, quality, simhash
from lakestrata.llm.common import Work
from lakestrata.llm.components import components


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 1 -------------------------------------------------------------------------------------------------------------------

def test_mix_on_awkward_rows(spark):
    docs = frame(spark)
    got = mixing.plan(docs).collect()
    assert len(got) == docs.count()
    sizes = defaultdict(int)
    for r in documents():
        sizes[r[3]] += len(words(r[1]))
    total = sum(sizes.values())
    targets = {r.source: r.target for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for r in got:
        assert r.size == len(words(r.text)) and r.source_size == sizes[r.source]
        assert r.target <= 2 * r.source_size and r.taken == r.copies * r.size and r.copies <= 2
    # targets below their cap are in proportion to the weights of their places
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    level = {targets[s] / (3, 1, 2)[i % 3] for i, s in enumerate(order) if targets[s] < 2 * sizes[s] - 1e-9}
    assert max(level, default=0) == pytest.approx(min(level, default=0))


def test_mix_emits_copies_and_repeats_itself(spark):
    docs = frame(spark)
    plan = Counter()
    for r in mixing.plan(docs).collect():
        plan[(r.doc_id, r.text)] += r.copies
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +plan
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mixed(docs.repartition(7)).collect()))
    assert mixing.mixed(empty(spark)).count() == 0


def test_mix_joins_many_sources_without_broadcast(spark, monkeypatch):
    want = sorted(map(str, mixing.plan(frame(spark)).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(str, mixing.plan(frame(spark)).collect())) == want


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 60), "en", f"s{i % 4}", 1, 1, 1.0, "k", 1) for i in range(6000)]
    taken, target = defaultdict(int), {}
    for r in mixing.plan(spark.createDataFrame(rows, SCHEMA)).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) < 0.05 * target[s]


# 2 -------------------------------------------------------------------------------------------------------------------

def fingerprint(text):
    w = words(lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_groups_by_brute_force(spark):
    rows = documents()
    prints = [fingerprint(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = roots(links, range(len(rows)))
    least = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]] = r[0] if least[root[i]] is None else min(r[0], least[root[i]])
    want = Counter((r[0], prints[i] - (1 << 64) * (prints[i] >> 63), least[root[i]]) for i, r in enumerate(rows))
    assert Counter(map(tuple, simhash.groups(frame(spark)).collect())) == want


@pytest.mark.parametrize("crowd", [0, 2, 32])
def test_simhash_links_crowds_completely(spark, crowd):
    rng = random.Random(crowd)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for centre in list(prints)[:4]:  # a crowd around each: up to four bits away, some from the edge outwards
        for _ in range(60):
            x = centre
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            prints.add(x)
            prints.add(x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = sorted(prints)
    signed = [p - (1 << 64) * (p >> 63) for p in prints]
    root = roots([(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4], range(len(prints)))
    want = {frozenset(signed[j] for j in range(len(prints)) if root[j] == root[i]) for i in range(len(prints))}
    got = defaultdict(set)
    linked = simhash.linked_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), Work(spark, "test"), crowd)
    for r in linked.collect():
        got[r.root].add(r.node)
    assert {frozenset(g) for g in got.values()} == {w for w in want if len(w) > 1}


def test_simhash_keeps_one_of_each_group(spark):
    docs = frame(spark)
    found = simhash.groups(docs).collect()
    ids = {r.component_id for r in found} - {None}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter([*ids, None, None])
    assert simhash.groups(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def test_simhash_keeps_groups_whose_least_id_has_other_texts(spark):
    one, two = " ".join("abcdefghij"), " ".join("klmnopqrst")
    rows = [(1, one, 7), (1, two, 8), (1, two, 6), (2, two, 5), (3, one, 4), (None, "alone", 1), (None, "alone", 2), (None, one, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `hash` int")
    assert Counter(map(tuple, simhash.keep_one(docs).collect())) == Counter([(1, one, 7), (1, two, 6), (None, "alone", 1)])


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Work(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1200)}}
    assert components(spark.createDataFrame([], "a long, b long"), Work(spark, "test")).count() == 0


# 3 -------------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def token_bytes(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()


def test_encoder_equals_the_tokenizer(tokenizer):
    encode = packing.Encoder(packing.VOCABULARY, packing.RANKS)
    rng = random.Random(2)
    odd = ["a", "é", " ", "\n", "  ", "'s", "1", "\t", "日", "<|endoftext|>", ".", " ", "\x1c", "\u0085", "😀"]
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 12))) for _ in range(3000)] + [r[1] or "" for r in documents()]
    for t in texts:
        assert encode(t) + b"\2\0\0\0" == token_bytes(tokenizer, t), t


def test_encoder_is_read_once_and_takes_whole_texts(tokenizer):
    encode = packing.encoder(packing.VOCABULARY, packing.RANKS)
    assert packing.encoder(packing.VOCABULARY, packing.RANKS) is encode
    plain, calls = encode._plain, []
    encode._plain = lambda text: calls.append(text) or plain(text)
    try:
        for t in [" ".join(f"w{i}x{j}." for j in range(50)) + "\nnext\n\nlast word" for i in range(20)]:
            assert encode(t) + b"\2\0\0\0" == token_bytes(tokenizer, t)
    finally:
        encode._plain = plain
    assert len(calls) == 20  # not one for each word that is new


def test_pack_round_trip(spark, tokenizer):
    docs = frame(spark)
    packed = packing.pack(docs, capacity=128)
    want = Counter((r[0], token_bytes(tokenizer, r[1])) for r in documents())
    rows = packed.collect()
    assert sum(want.values()) == sum(r.piece == 0 for r in rows)
    by_id = defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length <= 4 * 128
        by_id[r.doc_id].append(r)
    for doc_id, pieces in by_id.items():
        texts = [t for (i, t), n in want.items() for _ in range(n) if i == doc_id]
        assert sorted(r.ids for r in pieces) == sorted(t[4 * a : 4 * b] for t in texts for a, b in cuts(len(t) // 4, 128))
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r.length for r in rows)
    assert len(used) <= 1.05 * total / 128 + 1
    whole = packing.sequences(packed).collect()
    assert len(whole) == len(used) and sum(len(s.ids) for s in whole) == 4 * total
    assert packing.pack(empty(spark)).count() == 0


def cuts(n, capacity):
    first = n % capacity or capacity
    return [(0, first), *((a, a + capacity) for a in range(first, n, capacity))]


@pytest.mark.parametrize("capacity", [3, 10, 100, 1024])
def test_arrange_places_every_piece(capacity):
    rng = random.Random(capacity)
    for _ in range(40):
        counts = Counter(min(capacity, 1 + int(rng.expovariate(1 / (capacity * rng.uniform(0.01, 1))))) for _ in range(rng.randint(0, 800)))
        runs, n = packing.arrange(counts, capacity)
        placed, bins = Counter(), defaultdict(list)
        for length, a, b, first, offset, each in runs.tolist():
            placed[length] += b - a
            for j in range(b - a):
                bins[first + j // each].append((offset + j % each * length, length))
        assert placed == counts and len(bins) == n
        for spans in bins.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= capacity


# 5 -------------------------------------------------------------------------------------------------------------------

def test_license_sequences(spark):
    mit = """Copyright (c) 2020 Jane Doe\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, and so on.
    The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. In no event shall the authors or copyright holders be liable for any claim."""
    texts = [mit, "x. Licensed under the Apache License, Version 2.0.\n# You may not use this file except in compliance with the License.\nReleased under the MIT License!",
             None, "", "See the GNU General Public License for more details.", "a license to print money. " * 2000]
    got = {r.doc_id: (r.licenses, r.unmatched) for r in licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: ("MIT", ""), 1: ("Apache-2.0,MIT", ""), 2: ("", ""), 3: ("", ""), 4: ("", "gpl_see"), 5: ("", "")}
    assert licenses.scanned(frame(spark)).count() == len(documents()) and licenses.scanned(empty(spark)).count() == 0


WRAPPED = {
    "MIT": '''MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE.
''',
    "BSD-3-Clause": '''Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above
   copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
''',
    "Apache-2.0": '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''}
SEEN = {"MIT": "mit_title,copyright,mit_grant,mit_notice,mit_as_is,mit_liable", "BSD-3-Clause": "copyright,all_rights,bsd_grant,bsd_source,bsd_binary,bsd_names",
        "Apache-2.0": "apache2_named,apache2_comply,apache2_copy,apache2_unless,apache2_see"}


@pytest.mark.parametrize("sign,end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n")])
def test_wrapped_licenses(spark, sign, end):
    texts = [(k, "".join((sign + line).rstrip() + end for line in t.splitlines())) for k, t in WRAPPED.items()]
    got = {r.doc_id: (r.sentences, r.licenses, r.unmatched) for r in licenses.scanned(spark.createDataFrame(texts, "doc_id string, text string")).collect()}
    assert got == {k: (SEEN[k], k, "") for k in WRAPPED}


# 6 -------------------------------------------------------------------------------------------------------------------

def test_quality_learns_from_the_training_part_alone(spark, sf):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.train(docs, labels, sample=900)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.scored(docs, model).select("doc_id", "held_out", "score", "predicted").collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert sum(right) > 0.97 * len(right) > 0
    turned = labels.withColumn("quality", (labels.doc_id >= 0).cast("int") - labels.quality).filter("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    spoiled = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1").unionByName(turned)
    assert (quality.train(docs, spoiled, sample=900).table == model.table).all()


def test_quality_on_awkward_rows(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (4, 0), (5, None), (None, 1), (999, 1)], "doc_id long, quality int")
    out = quality.scored(docs, quality.train(docs, labels))
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sorted(out.columns) == sorted({*docs.columns, "held_out", "score", "predicted"})
    assert len({r.score for r in rows if not words(r.text)}) == 1
    none = quality.train(docs, labels.filter("false"))
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.kept(docs, labels).columns == docs.columns and quality.kept(empty(spark), labels).count() == 0


def test_quality_reads_long_texts_in_parts(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "GAMMA!!", "x"]) for _ in range(4000)).encode()
    model = quality.Model(np.random.default_rng(1).normal(size=1 << quality.BITS).astype(np.float32), 0.1)
    whole = model.scores([text, b"short"])
    monkeypatch.setattr(quality, "LONG", 3000)
    assert model.scores([text, b"short"]) == pytest.approx(whole, abs=1e-9)
    for between in (b"\t", b"\r", b"\r\n\x00 ", b"\x1f"):
        odd = text.replace(b" ", between)
        monkeypatch.setattr(quality, "LONG", 1 << 22)
        whole = model.scores([odd, b"", b" w" * 9 + b"long" * 500 + b"\tend"])
        monkeypatch.setattr(quality, "LONG", 300)
        assert model.scores([odd, b"", b" w" * 9 + b"long" * 500 + b"\tend"]) == pytest.approx(whole, abs=1e-9)
        assert all(len(p) < 400 or b"long" in p for p, _ in quality._parts(odd))


def plain_features(text):
    """Buckets of a text and their weights, one feature after the other."""
    whole, P = (1 << 64) - 1, int(quality._P)

    def bucket(h):
        h &= whole
        return ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & whole) >> (64 - quality.BITS)

    raw = bytes(32 if b <= 32 else b for b in b" " + text + b" ")
    out = Counter()
    for i in range(len(raw) - 2):
        if raw[i + 1] != 32:
            out[bucket(int.from_bytes(raw[i : i + 3], "little") * P)] += 1
            if raw[i + 2] != 32:
                out[bucket((int.from_bytes(raw[i : i + 4], "little") + (1 << 40)) * P)] += 1
    hashes = [sum(b * pow(P, j, 1 << 64) for j, b in enumerate(w)) & whole for w in raw.split()]
    for h in hashes:
        out[bucket(h + 3)] += quality.WORD_WEIGHT
    for g, h in zip(hashes, hashes[1:]):
        out[bucket((g ^ h) + 5)] += quality.WORD_WEIGHT
    return out


def test_quality_equals_a_plain_network():
    """Features, gradient descent, mean of the vectors and softmax, number by number, beside the folded model."""
    rng = random.Random(3)
    say = lambda vocabulary: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30))).encode()
    good, bad = ["the", "river", "über", "stone", "walks"], ["BUY", "now!!!", "$$$", "the", "click\there"]
    rows = [(say(good if i % 2 else bad), i % 2) for i in range(40)]
    counted = [(plain_features(t), y) for t, y in rows]
    model = quality.fit([(np.array(sorted(c)), np.array([float(c[k]) for k in sorted(c)]), y) for c, y in counted])
    draws = np.random.default_rng(quality.SEED)
    first, dim = draws.uniform(-1, 1, (1 << quality.BITS, quality.DIM)) / quality.DIM, range(quality.DIM)
    vectors = {k: [float(x) for x in first[k]] for c, _ in counted for k in c}
    w = (draws.uniform(-1, 1, (2, quality.DIM)) / quality.DIM).tolist()
    share = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
    bias, speed = [float(np.log(1 - share)), float(np.log(share))], dict.fromkeys(vectors, 1e-8)

    def mean(c):
        return [sum(n * vectors.get(k, first[k])[d] for k, n in c.items()) / max(sum(c.values()), 1) for d in dim]

    def softmax(h):
        z = [np.exp(sum(w[j][d] * h[d] for d in dim) + bias[j]) for j in (0, 1)]
        return [x / sum(z) for x in z]

    batches = -(-len(rows) // quality.BATCH)
    for epoch in range(quality.EPOCHS):
        order = draws.permutation(len(rows))
        for b in range(batches):
            rate = quality.RATE * (1 - (epoch * batches + b) / (quality.EPOCHS * batches))
            chosen = [counted[i] for i in order[b * quality.BATCH : (b + 1) * quality.BATCH]]
            grad, step = {}, [[0.0] * quality.DIM, [0.0] * quality.DIM]
            for c, y in chosen:
                h = mean(c)
                off = [p - (j == y) for j, p in enumerate(softmax(h))]
                for j in (0, 1):
                    step[j] = [step[j][d] + off[j] * h[d] for d in dim]
                for k, n in c.items():
                    g = grad.setdefault(k, [0.0] * quality.DIM)
                    for d in dim:
                        g[d] += n / sum(c.values()) * sum(off[j] * w[j][d] for j in (0, 1))
            w = [[w[j][d] - rate * step[j][d] / len(chosen) for d in dim] for j in (0, 1)]
            for k, g in grad.items():
                speed[k] += sum(x * x for x in g)
                vectors[k] = [vectors[k][d] - rate * g[d] / speed[k] ** 0.5 for d in dim]
    texts = [*(t for t, _ in rows), b"", b"   ", say(good + bad), b"unseen words alone", "großes Ü\u2028x".encode()]
    assert model.scores(texts) == pytest.approx([softmax(mean(plain_features(t)))[1] for t in texts], abs=1e-5)
    got = model.scores([t for t, _ in rows])
    assert sum((p > 0.5) == bool(y) for p, (_, y) in zip(got, rows)) >= 36


def test_licences_over_white_space_and_further_names(spark):
    said = {
        "This work is released into the public\ndomain.": "Public-Domain", "It was good.\nThis work is dedicated to the public  domain by me.": "Public-Domain",
        "All  rights  reserved.": "Proprietary", "Copyright (c) 2020 Me.\nAll rights\nreserved.": "Proprietary", "SPDX-License-Identifier: LGPL-2.1-only": "LGPL",
        "# SPDX-License-Identifier: ISC": "ISC", "License: MIT": "MIT", "Licensed under MIT": "MIT", "SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
        "Licensed under the Mozilla Public License, v. 2.0.": "MPL-2.0", "Licensed under the Eclipse Public License 2.0": "EPL-2.0", "Released under the ISC license.": "ISC",
        "This is free and unencumbered software released into the public domain.": "Unlicense", "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
        "Available under the GNU Affero General Public License, version 3.": "AGPL-3.0", "SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT",
        "/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-2-Clause AND ISC */": "GPL-2.0,BSD,ISC", "SPDX-License-Identifier: GPL-3.0+": "GPL-3.0",
        "MIT License": "MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Me": "MIT", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/": "Apache-2.0",
        "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "GPL-3.0", "BSD 3-Clause License": "BSD-3-Clause", "We chose the MIT License because it is short.": "",
        "SPDX-License-Identifier: LicenseRef-Mine": "",
    }
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scanned(docs).collect()}
    assert {t: got[i].licenses for i, t in enumerate(said)} == said
    assert got[len(said) - 1].unmatched == "spdx_other"
    texts = [*said, None, "", "x", *(re.sub(r"(?m)^", sign, t).replace("\n", end) for t in [*WRAPPED.values(), *said] for sign, end in (("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\r")))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    columns = ("doc_id", "sentences", "licenses", "unmatched")
    assert sorted(map(tuple, licenses.scanned(docs).select(*columns).collect())) == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({licenses.oracle()})").fetchall())


# 7 -------------------------------------------------------------------------------------------------------------------

def test_secrets_by_brute_force(spark):
    rng = random.Random(2)
    parts = ["token", "Secret", "=", ":", " ", '"', "'", "abcdef0123456789", "AKIA", "QWERTY12345678", "é😀", "x", "password", "API_KEY", "\n", "-", "0f", "secret=", "abcdefghijklm"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(800)] + [(900, None), (901, ""), (None, "token=abcdefghijklmnop"), (902, "token=abcdefghijklmnop " * 500)]
    rows += rows[:5]
    found, _ = ledger.findings(spark.createDataFrame(rows, "path long, text string"))
    base = [r.kind for r in ledger.RULES if r.base]
    out = found.select("path", ledger.listed(found["found"], base).alias("spans"), *[ledger.count(found["found"], k).alias(k) for k in base]).collect()
    want = Counter((p, listing(secret(t or ""), base)) for p, t in rows)
    assert Counter((r.path, r.spans) for r in out) == want
    assert all(r[k] == r.spans.count(k + ":") for r in out for k in base)


def test_ledger_scans_only_what_it_has_not_seen(spark):
    first = spark.createDataFrame([("a", "token=abcdefghijklmnop"), ("b", "plain"), ("b", "plain")], "path string, text string")
    _, seen = ledger.findings(first)
    assert seen.count() == 2 * len(ledger.RULES)
    later = spark.createDataFrame([("a", "token=abcdefghijklmnop"), ("c", "token=abcdefghijklmnop"), ("d", "deadbeefdeadbeef")], "path string, text string")
    assert [r.text for r in ledger.unseen(later, ledger=seen).collect()] == ["deadbeefdeadbeef"]
    newer = (*ledger.RULES[1:], ledger.Rule("assign", 2, "token"))
    assert ledger.unseen(later, newer, seen).count() == 2
    assert {(r.kind, r.version) for r in ledger.scan(ledger.unseen(later, newer, seen), newer, seen).collect() if r.sha256 == hashlib.sha256(b"token=abcdefghijklmnop").hexdigest()} == {("assign", 2)}
    found, now = ledger.findings(later, ledger=seen)
    assert now.count() == 3 * len(ledger.RULES)
    assert {r.path: [x.kind for x in r.found] for r in found.collect()} == {"a": ["assign"], "c": ["assign"], "d": ["hex"]}
    assert ledger.findings(first.filter("false"))[0].count() == 0


# 9 -------------------------------------------------------------------------------------------------------------------

def test_pii_base_spans_by_brute_force():
    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice("1234567890.@ +-()a\n") for _ in range(rng.randint(0, 60)))
        assert sorted((a, k, b) for a, b, k in pii.base_spans(t)) == personal(t), t


def test_pii_field_learns_the_kinds_and_leaves_look_alikes():
    weights = pii.train([])
    for text, kind in [("jo.doe@mail9.example.com", 0), ("jo.doe(at)mail9.example.com", 0), ("190.137.2.44", 1), ("4111 1111 1111 1111", 2), ("+1 (826) 555-4081", 3)]:
        assert pii.decode(weights, text) == [(0, len(text), kind)], text
    for text in ("2024-05-06", "3.14.15", "4111111111111112", "9f86d081884c7d659a2feaa0c55ad015", "@home", "999.999.999.999"):
        assert pii.decode(weights, text) == [], text


def test_pii_finds_disguised_addresses_without_digits(spark):
    rows = [(1, "write to jane.doe(at)example.com today", 0), (2, "in 2024 (jane_doe[AT]example.co.uk)", 0), (3, "they met(at)noon and look(at)this", 0), (4, None, 0), (5, "jd(at)host.org", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: r.pii.spans for r in pii.find(docs).collect()}
    assert found == {1: ["email:9:32"], 2: ["email:9:34"], 3: [], 4: [], 5: ["email:0:14"]}
    assert {r.doc_id: r.text for r in pii.redacted(docs).collect()} == {1: "write to [EMAIL] today", 2: "in 2024 ([EMAIL])", 3: rows[2][1], 4: None, 5: "[EMAIL]"}


def test_pii_gradient_follows_the_likelihood():
    import math

    cuts_, segments = pii._segments("call +1 (826) 555-4081 now")
    n, weights, eps = len(cuts_) - 1, {"bias": [0.1, -0.2, 0.3, 0.4]}, 1e-5
    gold = {(segments[0][0], segments[0][1], 3)}

    def likelihood(w):
        total = [0.0] * (n + 1)
        for j in range(1, n + 1):
            total[j] = pii._log_add([total[j - 1], *(total[i] + s for i, e, f in segments if e == j for s in pii._score(w, f))])
        return sum(pii._score(w, f)[k] for i, e, f in segments for k in range(4) if (i, e, k) in gold) - total[n]

    stepped = {k: list(v) for k, v in weights.items()}
    pii._gradient(stepped, n, segments, gold, 1.0)
    for k in range(4):
        moved = {"bias": [w + eps * (i == k) for i, w in enumerate(weights["bias"])]}
        assert stepped["bias"][k] - weights["bias"][k] == pytest.approx((likelihood(moved) - likelihood(weights)) / eps, rel=1e-3, abs=1e-4)
    assert math.isfinite(likelihood(weights))


def test_pii_on_awkward_rows(spark):
    docs = frame(spark)
    rows = pii.find(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert ",".join(r.pii.base) == listing(personal(r.text or ""), pii.KINDS) and set(r.pii.base) <= set(r.pii.spans)
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    assert all(r.text is None or (r.n_chars == len(r.text) and not personal(r.text)) for r in out.collect())
    assert pii.find(empty(spark)).count() == 0
    assert luhn("4111111111111111") and pii.luhn("4111111111111111")


# 10 ------------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_minhash_beside_next_and_edited(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = sorted(documents(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        got = sorted(minhash.compared(frame(spark)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars, r.fingerprint))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    hasher, want = minhash.Hasher(), []
    for i, r in enumerate(rows):
        t, o = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + o[:half]
        a, b, c = minhash._short(hasher.signatures([minhash.normal(x) for x in (t, e, o)]))
        want.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), minhash._text_of(a), minhash._text_of(b), float((a == b).mean()), float((a == c).mean())))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))
    assert [tuple(r) for r in got] == want
    assert minhash.compared(empty(spark)).count() == 0
    one = minhash.compared(frame(spark, [rows[0]])).first()
    assert one.near_next == 1.0


def test_minhash_estimates_likeness():
    rng = random.Random(5)
    hasher = minhash.Hasher()
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 9) for _ in range(400)]
    for share in (0.0, 0.02, 0.1, 0.5):
        other = [x if rng.random() >= share else x + "z" for x in base]
        sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (base, other)]
        a, b = minhash._short(hasher.signatures([" ".join(base).encode(), "\n".join(other).encode()]))
        assert (a == b).mean() == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]), abs=0.13)


def test_minhash_parts_and_shared_heads_change_nothing(monkeypatch):
    rng = random.Random(6)
    hasher = minhash.Hasher()
    texts = ["".join(rng.choice(["a", "b", "é", " ", "\n", "  ", "cd"]) for _ in range(rng.randint(0, 400))) for _ in range(120)]
    whole = hasher.signatures([t.encode() for t in texts])
    for limit in (40, 100):
        parts = [list(minhash._parts(t.encode(), limit)) for t in texts]
        for t, p, row in zip(texts, parts, whole):
            assert (np.min(hasher.signatures(p), axis=0) == row).all(), t
    for a, b in zip(texts, texts[1:]):
        r = minhash._rows([(0, False, 1, a), (0, False, 2, b)], hasher)[0]
        x, y = minhash._short(hasher.signatures([a.encode(), minhash.edited(a, b).encode()]))
        assert (r[3], r[4]) == (minhash._text_of(x), minhash._text_of(y))


def test_minhash_groups_by_brute_force(spark):
    rows = [r for r in documents() if r[0] is not None]
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (not sets[i] and not sets[j]) or (sets[i] & sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))]
    root = roots(links, range(len(rows)))
    least = {k: min(rows[i][0] for i in range(len(rows)) if root[i] == k) for k in set(root.values())}
    got = minhash.near_groups(frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == Counter((r[0], least[root[i]]) for i, r in enumerate(rows))

def five(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_roots(rows):
    sets = [five(r[1]) for r in rows]
    like = lambda a, b: not (a or b) or 5 * len(a & b) >= 4 * len(a | b) > 0
    return roots([(i, j) for i in range(len(rows)) for j in range(i) if like(sets[i], sets[j])], range(len(rows)))


def test_near_copies_by_brute_force(spark):
    rng = random.Random(6)
    rows = documents()
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    for i in range(30):  # 0.8 to 1 like the base, mostly more than four bits of SimHash away
        text = list(base)
        for k in rng.sample(range(300), rng.randint(1, 7)):
            text[k] = f"v{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(text), "en", "s1", 1, 1, 1.0, "k", 1))
    for i in range(30):  # half a passage of many, and an id that two texts have
        rows.append((2000 + i, " ".join(base[:200] + [f"u{rng.randrange(10**6)}" for _ in range(100)]), "en", "s1", 1, 1, 1.0, "k", 1))
        rows.append((2000 + i, f"alone {i} for itself", "en", "s1", 1, 1, 1.0, "k", 1))
    docs = frame(spark, rows)
    root = near_roots(rows)
    least = {k: min((rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if root[i] == k) for k in set(root.values())}
    got = Counter(map(tuple, minhash.near_groups(docs).collect()))
    assert got == Counter((r[0], least[root[i]][1] if not least[root[i]][0] else None) for i, r in enumerate(rows))
    # the pipeline's stage groups by SimHash: at most four differing bits over four-word shingles
    prints = [fingerprint(r[1]) for r in rows]
    root = roots([(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4], range(len(rows)))
    out = corpus_pipeline.deduplicate(spark, docs, "").collect()
    assert list(out[0].asDict()) == docs.columns
    place = {(r[0], r[1]): root[i] for i, r in enumerate(rows)}
    assert sorted(place[(r.doc_id, r.text)] for r in out) == sorted(set(root.values()))
    least = {k: min((rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if root[i] == k) for k in set(root.values())}
    assert all((r.doc_id is None, r.doc_id or 0) == least[place[(r.doc_id, r.text)]] for r in out)
    assert corpus_pipeline.deduplicate(spark, empty(spark), "").count() == 0


def test_personal_data_has_no_reach_and_no_longest_part():
    zeros = "1.2.3." + "0" * 1200 + "4"
    assert pii.base_spans(f"at {zeros}.") == [(3, 3 + len(zeros), 1)]
    assert pii.base_spans("0001.2.3.0256") == [] and pii.base_spans("0.0.0.0") == [(0, 7, 1)]
    assert [m for m in pii.base_spans(zeros) if m[2] == 1] == [s for s in ((a, e, k) for a, k, e in personal(zeros)) if s[2] == 1]
    for n in (10, 80, 700):
        text = "see " + "a" * n + "(at)example.com now"
        assert list(pii.regions(text)) == [(4, len(text) - 4)]


def test_secrets_of_one_text_with_very_many(spark, monkeypatch):
    for block in (3, 256):
        monkeypatch.setattr(ledger, "BLOCK", block)
        texts = ["é token=abcdefghijkl%04d deadbeef%08x\n" % (i % 9973, i) * 1 for i in range(700)]
        rows = [(1, "".join(texts)), (2, "".join(texts[:block])), (3, "".join(texts[: block + 1])), (4, "none")]
        found, _ = ledger.findings(spark.createDataFrame(rows, "path long, text string"))
        got = {r.path: r.x for r in found.select("path", ledger.listed(found["found"], ["assign", "access", "hex"]).alias("x")).collect()}
        assert got == {i: listing(secret(t), ["assign", "access", "hex"]) for i, t in rows}


def test_long_texts_with_very_many_finds(spark):
    n = 20_000
    texts = ["All rights reserved.\n" * n, "SPDX-License-Identifier: MIT\n" * n, "no cue " * n, "Copyright (c) 2001" + ", 2002" * n + " Me", "licence\n" + "- " * n * 10 + "x", ("MIT License\n" + "Copyright (c) 2020 Me\n") * n]
    got = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(r.sentences.count(",") + bool(r.sentences), r.licenses) for r in sorted(got)] == [(n, "Proprietary"), (n, "MIT"), (0, ""), (1, ""), (0, ""), (2 * n, "MIT")]
    many = " ".join(f"user{i}@example.org" for i in range(n))
    found = pii.find(spark.createDataFrame([(1, many)], "doc_id long, text string")).first()
    assert len(found.pii.base) == n and all(x.startswith("email:") for x in found.pii.base)
