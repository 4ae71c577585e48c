"""The corpus operators against brute force on small tables, with nulls, empty and
long texts, ties, repeated rows, empty tables and extra columns whose names clash."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from gristmill.llm import (bpe, components, decontaminate, htmltext, licenses, linededup, quality, sharding, simhash,
                           suffixes, topk)
from gristmill.llm.common import Scratch

SCHEMA = ("doc_id long, text string, source string, id string, w int, fp int, digest string, text_key int, score string, "
          "shard int, hash int, n_tokens int, _n_lines int, host int, template int")
CLASH = (None,) * 12
RNG = random.Random(11)


def words(n, alphabet="abcdefg", rng=RNG):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(n))


def docs_frame(spark, rows):
    """rows: (doc_id, text[, source])"""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "s") + CLASH for r in rows], SCHEMA)


# SimHash

def brute_fingerprint(text, k=3):
    ws = (text or "").encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in ([ws[i:i + k] for i in range(len(ws) - k + 1)] if len(ws) > k else [ws] if ws else [])]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, bits):
    """prints: fingerprints; the component number of each."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near_copies():
    base = words(120).split()
    out = []
    for k in range(40):
        ws = list(base)
        for _ in range(RNG.choice([0, 0, 1, 1, 2])):
            ws[RNG.randrange(len(ws))] = words(1)
        out.append(" ".join(ws))
    return out


def test_simhash_groups(spark):
    texts = near_copies() + [words(RNG.randint(1, 60)) for _ in range(40)] + [None, "", " \t\n", "One", "one two", "ONE TWO", "é È é"]
    texts.append(words(30_000))
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[7]), (None, "alone and without an id")]
    prints = [brute_fingerprint(t) for _, t in rows]
    groups = defaultdict(list)
    for (i, _), c in zip(rows, brute_components(prints, 2)):
        groups[c].append(i)
    expected = Counter()
    for (i, _), p, c in zip(rows, prints, brute_components(prints, 2)):
        ids = [x for x in groups[c] if x is not None]
        expected[(i, f"{p:016x}", min(ids) if ids else None)] += 1
    got = simhash.near_duplicate_groups(docs_frame(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_simhash_links_by_bits(spark):
    rng = random.Random(3)
    prints = []
    for _ in range(30):
        p = rng.getrandbits(64)
        prints += [p] + [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(4)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    for bits in (0, 1, 2, 3):
        roots = {r["node"]: r["root"] for r in components.components(simhash.links(frame, bits), Scratch(spark, "t")).collect()}
        comp = brute_components(prints, bits)
        assert len({(c, roots.get(s, s)) for c, s in zip(comp, signed)}) == len(set(comp)) == len({roots.get(s, s) for s in signed})


def test_simhash_dedup_keeps_one_row_of_a_group(spark):
    rows = [(4, "a b c d"), (2, "A B C D"), (9, "x y z"), (9, "x y z"), (None, "x  y z"), (7, None), (3, "")]
    kept = simhash.drop_near_duplicates(docs_frame(spark, rows))
    assert kept.columns[:3] == ["doc_id", "text", "source"]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(2, "A B C D"), (3, ""), (9, "x y z")]
    assert simhash.drop_near_duplicates(docs_frame(spark, [])).count() == 0
    assert simhash.near_duplicate_groups(docs_frame(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links, Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


# Byte-level BPE

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_merges_like_the_library(reference_encoding):
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    assert codec.cuts_at_spaces
    rng = random.Random(5)
    alphabet = "ab é\n\t\x1c\x85 　１½Ⅷ²'sS'll!?-_́\U0001F600中文\x00ß"
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    samples += ["".join(rng.choice("aeiothrn") for _ in range(n)) for n in (64, 65, 300, 3000)] + ["a  b   c ", " lead", "trail "]
    for s in samples:
        ids = codec.encode(s)
        assert ids == reference_encoding.encode_ordinary(s), s
        assert codec.decode(ids) == s.encode()


def test_bpe_stitches_chunks(spark, reference_encoding):
    rng = random.Random(6)
    texts = [None, "", "one", words(400, "abé中 \n"), "x" * 700, words(60) + "y" * 500 + words(60), (" " * 90 + "\n") * 8,
             "".join(rng.choice("ab 1!\n '") for _ in range(3000)), "don't " * 200]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[3])]
    got = bpe.encode_documents(docs_frame(spark, rows), PATH, public_tokenizers.PATTERN, chunk_chars=100, overlap=24)
    expected = Counter()
    for i, t in rows:
        ids = reference_encoding.encode_ordinary(t or "")
        expected[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == expected
    assert bpe.encode_documents(docs_frame(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


# Quality classifier

def test_trees_learn_and_flat_arrays_agree_with_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = quality.fit(x[:2000], y[:2000])
    score = trees.score(x[2000:])
    assert ((score > 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        margin = trees.prior
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + (row[f[at]] > t[at])
            margin += leaf[at - len(f)]
        return 1 / (1 + np.exp(-margin))
    assert np.allclose([walk(r) for r in x[2000:2050]], score[:50])
    assert quality.fit(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert (quality.fit(x[:9], np.ones(9)).score(x[:3]) > 0.9).all()


def test_quality_held_out_and_edges(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, words(40, rng=rng).upper() + "!!!" if bad else words(40, rng=rng) + "."))
        labels.append((i, 0 if bad else 1, i))
    rows += [(1000, None), (1001, ""), (1002, "\n"), (None, "x"), (5, rows[5][1]), (1003, words(20_000))]
    labels += [(None, 1, 0), (7, None, 0), (8, 0, 0), (8, 0, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    got = quality.score_documents(docs_frame(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 != 0) for r in held]) > 0.95
    none = quality.score_documents(docs_frame(spark, rows[:3]), lab.where("false")).collect()
    assert [r["score"] for r in none] == [0.5] * 3
    assert quality.score_documents(docs_frame(spark, []), lab).count() == 0


def test_quality_never_learns_from_the_held_out_fold(spark):
    rows = [(i, words(20)) for i in range(50)]
    lab = spark.createDataFrame([(i, 0) for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0], "doc_id long, quality int")
    assert quality.score_documents(docs_frame(spark, rows), lab).where("score <> 0.5").count() == 0


# Exact top-k

def brute_top(rows, k, asked):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault((i, tuple(np.floor(64 * np.asarray(v, float)).astype(int))), None)
    out = Counter()
    for i, v in vectors:
        if asked(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != i and len(w) == len(v))
            out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k]))
    return out


def test_topk_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 5])).tolist()) for i in range(300)]
    rows += [(i, rows[4][1]) for i in range(300, 340)]  # ties
    rows += [(340 + i, (np.array(rows[8][1]) * (1 + i / 1000)).tolist()) for i in range(20)]  # high cosines
    rows += [rows[3], (400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, rows[0][1]),
             (404, [1.0, 2.0]), (410, [0.5, 0.1]), (420, []), (430, [0.0] * 8)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = brute_top(rows, 7, lambda i: i % 10 == 0)
    for options in ({}, {"buckets": 5, "block_rows": 20, "query_rows": 9}):
        got = topk.top_k(frame, F.col("id") % 10 == 0, 7, **options)
        assert Counter(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == expected
    assert topk.top_k(frame.where("false"), F.col("id") % 10 == 0, 7).count() == 0


def test_topk_prunes_by_coordinate_without_loss():
    rng = np.random.default_rng(4)
    base = rng.normal(size=16) * 100
    c = np.floor(base + rng.normal(size=(3000, 16)) * 3)
    c[1500:] = np.floor(rng.normal(size=(1500, 16)) * 100)
    q = np.floor(base + rng.normal(size=(5, 16)) * 3)
    norm = np.linalg.norm
    ids = np.arange(3000)
    found = topk.search_block(np.arange(5) + 9000, q, norm(q, axis=1), np.full(5, -np.inf), ids, c, norm(c, axis=1), 10)
    for i in range(5):
        best = sorted(zip(-(c @ q[i]), ids))[:10]
        assert [(int(a), -b) for a, b in zip(*found[i])] == [(int(j), s) for s, j in best]


@pytest.mark.parametrize("noise", [0, 10, 80, 300])
def test_topk_keeps_candidates_along_a_dominant_coordinate(noise):
    rng = np.random.default_rng(6)
    axes = np.concatenate([np.eye(16)[:3], -np.eye(16)[:3]])
    # the longer a candidate, the farther it lies from its axis; the best scores are in later runs
    cosine = rng.uniform(0.8, 1, 6000)
    side = np.concatenate([np.zeros((6000, 3)), rng.normal(size=(6000, 13))], axis=1)
    side /= np.linalg.norm(side, axis=1)[:, None]
    c = cosine[:, None] * axes[rng.integers(0, 6, 6000)] + np.sqrt(1 - cosine ** 2)[:, None] * side
    c = np.floor(c * (2000 - 800 * cosine + rng.normal(size=6000) * 20)[:, None])
    q = np.floor(axes * 1000 + rng.normal(size=(6, 16)) * noise)
    norm = np.linalg.norm
    ids = np.arange(6000)
    found = topk.search_block(np.arange(6) + 9000, q, norm(q, axis=1), np.full(6, -np.inf), ids, c, norm(c, axis=1), 10)
    for i in range(6):
        best = sorted(zip(-(c @ q[i]), ids))[:10]
        assert [(int(a), -b) for a, b in zip(*found[i])] == [(int(j), s) for s, j in best]


# Decontamination

def brute_items(docs, items, k=5):
    def shingles(t):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        return {" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()
    best = {}
    sets = {}
    for d, t in docs:
        sets[(d, t)] = shingles(t)
    for i, t in items:
        s = shingles(t)
        for key, have in sets.items():
            if s and len(s & have) * 5 >= len(s) * 4:
                best[(key, i)] = max(best.get((key, i), 0), len(s & have) / len(s))
    return Counter((d, i, c) for ((d, _), i), c in best.items())


def test_decontamination_exact(spark):
    rng = random.Random(9)
    items = [(i, words(rng.randint(1, 60), "abcdefghijkl", rng)) for i in range(40)]
    items += [(40, None), (41, ""), (42, "..!"), items[3], (5, "another text of the same item id"), (None, words(20, "mnop", rng))]
    docs = [(i, words(rng.randint(0, 80), rng=rng)) for i in range(30)]
    for k, (_, t) in enumerate(items):
        ws = (t or "").split()
        if ws and rng.random() < 0.5:
            ws[rng.randrange(len(ws))] = "Zz"
        docs.append((100 + k, words(30, rng=rng) + "\n" + ", ".join(ws).upper() + ". " + words(rng.choice([5, 2000]), rng=rng)))
    docs += [docs[35], (None, docs[36][1]), (7, docs[37][1]), (800, None), (801, "")]
    frame, bench = docs_frame(spark, docs), spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, id int")
    expected = brute_items(docs, items)
    for rows in (1_000_000, 0):  # broadcast, and the join by shuffle
        got = decontaminate.find_items(frame, bench, broadcast_rows=rows)
        assert Counter((r["doc_id"], r["item_id"], r["containment"]) for r in got.collect()) == expected
    dirty = {d for d in docs if any(c[0] == d[0] for c in brute_items([d], items))}
    left = decontaminate.drop_contaminated(frame, bench)
    assert left.columns == frame.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(d for d in docs if d not in dirty)
    assert decontaminate.find_items(frame, bench.where("false")).count() == 0
    assert decontaminate.drop_contaminated(docs_frame(spark, []), bench).count() == 0


# Sharding

def test_shards_are_even_gapless_and_mixed(spark):
    rows = [(i, "t" * (i % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    rows += [(7, "same", None)] * 40 + [(None, None, "hot"), (None, "é", None)]
    got = sharding.shard_documents(docs_frame(spark, rows), 7).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    source = {(i, len((t or "").encode()) + 8): s for i, t, s in rows}
    hot = Counter(r["shard"] for r in got if source[(r["doc_id"], r["size"])] == "hot")
    # each stratum shifts a cut by at most half a row, so a shard's share is off by the number of strata at most
    assert max(hot.values()) - min(hot.values()) <= len(set(s for _, _, s in rows))
    again = sharding.shard_documents(docs_frame(spark, rows).repartition(5), 7).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert sharding.shard_documents(docs_frame(spark, []), 7).count() == 0


# Licences

def test_license_places(spark):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [None, "", "MIT License", "mit", "license mit", "the mit-license; MIT  License.", "mit licenseé", "MİT License",
             "General\npublic LICENSE general public license", "apache license" * 3, "apache license " * 500, words(3000),
             "Permission is hereby granted, free of charge, to any person obtaining a copy", "Licensed under the Apache License, Version 2.0",
             "GNU Lesser General Public License", "Redistribution and use in source and binary forms", "public license general"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[2])]
    expected = Counter()
    for i, t in rows:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
        at = [(j, b.label) for b in licenses.BASE for j in range(len(ws)) if ws[j:j + len(b.key_words)] == b.key_words]
        starts = [j for j, _ in at]
        expected[(i, len(ws), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))] += 1
    got = licenses.scan(docs_frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == expected
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got}
    assert labels[0] == ("", 0.0) and labels[2] == ("mit", 1.0) and labels[14] == ("gpl,lgpl", 1.0)
    assert labels[12] == ("mit", 13 / 16) and labels[13] == ("apache", 1.0) and labels[15][0] == "bsd"
    assert licenses.scan(docs_frame(spark, [])).count() == 0


# Suffix dedup

def brute_cut(texts, length):
    count = Counter()
    data = [(t or "").encode() for t in texts]
    for b in data:
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        out.append((len(b), sum(mark), len(re.findall(b"\1+", mark)), bytes(c for c, m in zip(b, mark) if not m)))
    return out


@pytest.mark.parametrize("broadcast_rows,bucket_rows", [(1_000_000, 20_000), (0, 3)])
def test_suffix_dedup_exact(spark, broadcast_rows, bucket_rows):
    rng = random.Random(7)
    base = "".join(rng.choice("abcdefg hij") for _ in range(1600))

    def edit(k):
        out = list(base)
        for _ in range(k):
            out[rng.randrange(len(out))] = rng.choice("XYZW")
        return "".join(out)
    texts = [edit(rng.choice([0, 1, 2, 3, 8])) for _ in range(30)] + ["a" * 700, "ab" * 400, "Eroresat " * 120, "Eroresat " * 90 + "x",
             None, "", "short", base[100:520] + "zzz", base[700:1099], base[700:1100], "q" * 50 + base[1000:1500] + "w" * 300 + base[:401]]
    for _ in range(12):
        a = rng.randrange(1000)
        texts.append("".join(rng.choice("klmnop") for _ in range(rng.randrange(300))) + base[a:a + rng.randrange(380, 600)]
                     + "".join(rng.choice("klmnopé") for _ in range(rng.randrange(300))))
    rows = [(i % 40 if i != 3 else None, t) for i, t in enumerate(texts)] + [(50, texts[37])]
    got = suffixes.remove_repeats(docs_frame(spark, rows).repartition(3), broadcast_rows=broadcast_rows,
                                  bucket_rows=bucket_rows).collect()
    cut = brute_cut([t for _, t in rows], 400)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == Counter(
        (d, *c) for (d, _), c in zip(rows, cut))


def test_suffix_anchors_at_block_edges(monkeypatch):
    rng = random.Random(3)
    passage = bytes(rng.choice(b"abcdefgh") for _ in range(500))
    texts = [bytes(rng.choice(b"ijklmnop") for _ in range(n)) + passage + bytes(rng.choice(b"qrstuvwx") for _ in range(900))
             for n in (0, 130, 260, 700, 1001)] + [b"a" * 1500, b"ab" * 700, b"x" * 400]
    whole = [list(suffixes.anchors(t, 400)) for t in texts]
    for block in (1, 7, 100, 256, 300, 1024):
        monkeypatch.setattr(suffixes, "_BLOCK", block)
        for text, expected in zip(texts, whole):
            got = list(suffixes.anchors(text, 400))
            assert got == expected
            assert len({pos for pos, _, _ in got}) == len(got)
            assert sorted(pos - k for pos, far, near in got for k in range(near, far + 1)) == list(range(len(text) - 399))


def test_suffix_dedup_passages_across_block_edges(monkeypatch):
    # one task's steps in this process, as executors do not see a changed block size
    monkeypatch.setattr(suffixes, "_BLOCK", 300)
    rng = random.Random(5)
    passage = bytes(rng.choice(b"abcdefgh") for _ in range(520))
    texts = [bytes(rng.choice(b"ijklmnop") for _ in range(n)) + passage + bytes(rng.choice(b"qrstuvwx") for _ in range(300))
             for n in range(0, 600, 29)]
    rows = pd.concat(pd.DataFrame([(bytes([i]), pos, far, near, False, False, t[pos:pos - near + 400], t[pos - far:pos][::-1])
                                   for pos, far, near in suffixes.anchors(t, 400)],
                                  columns=["digest", "pos", "far", "near", "shared", "hot", "right", "left"])
                     for i, t in enumerate(texts))
    covered = defaultdict(set)
    for part in suffixes._sort_bucket(400)([rows]):
        for digest, start, stop in zip(part["digest"], part["start"], part["stop"]):
            covered[digest[0]].update(range(start, stop))
    starts = defaultdict(list)
    for i, t in enumerate(texts):
        for at in range(len(t) - 399):
            starts[t[at:at + 400]].append((i, at))
    expected = defaultdict(set)
    for places in starts.values():
        for i, at in places if len(places) > 1 else ():
            expected[i].update(range(at, at + 400))
    assert covered == expected and len(expected) == len(texts)


def test_suffix_dedup_empty(spark):
    assert suffixes.remove_repeats(docs_frame(spark, [])).count() == 0


def test_multikey_quicksort_and_buckets_across_boundaries():
    rng = random.Random(12)
    rows = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    flat, tokens, sizes = suffixes._tokens(rows, 30)
    order = suffixes.multikey_quicksort(tokens, sizes)
    assert [rows[i] for i in order] == sorted(rows)


# Lines

def brute_lines(rows, min_chars=40, min_docs=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [i is not None and len(holders[key(x)]) >= min_docs and i < max(holders[key(x)]) for x in lines]
        out[(i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone))] += 1
    return out


def test_line_dedup_exact(spark):
    rng = random.Random(4)
    shared = [words(12, "abcé", rng)[:60].ljust(40, "x") for _ in range(6)]
    rows = []
    for i in range(60):
        lines = [rng.choice(shared + [words(9, rng=rng)]) for _ in range(rng.randint(0, 9))]
        rows.append((i, "\n".join(x.upper().replace("É", "é") + " \t" if rng.random() < 0.3 else x for x in lines)))
    rows += [rows[9], rows[9], (9, shared[0] + "\n" + shared[1]), (None, shared[0] + "\nx"), (70, None), (71, ""), (72, "\n\n"),
             (73, "\n".join([shared[0], "k"] * 400)), (74, shared[0][:39]), (75, "\n".join(shared))]
    frame = docs_frame(spark, rows)
    got = linededup.dedup_lines(frame)
    assert Counter((r["doc_id"], r["text"], r["_n_lines"], r["_n_dropped"]) for r in got.collect()) == brute_lines(rows)
    assert linededup.dedup_lines(docs_frame(spark, [])).count() == 0


def test_first_occurrences_are_sorted_and_streamed(spark):
    lines = spark.createDataFrame([(1, 1, 5, 3), (1, 1, 5, 0), (1, 1, 4, 2), (2, 1, 5, 9)], "h1 long, h2 int, doc long, pos int")
    first = linededup.first_occurrences(lines)
    assert sorted(tuple(r) for r in first.collect()) == [(1, 1, 4, 2), (1, 1, 5, 0), (2, 1, 5, 9)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "hashpartitioning" not in plan
    assert re.search(r"Sort \[h1\S* ASC NULLS FIRST, h2\S* ASC NULLS FIRST, doc\S* ASC NULLS FIRST, pos", plan)


# HTML

def page(body, host="a.example"):
    return (f"http://{host}/x", body)


def test_html_parse_and_extract():
    out = lambda h, t=None: htmltext.extract(h, t)
    assert out(None) == out("") == ""
    assert out("<p>a &amp;  b\n c<br>d<p>e&nbsp;f</p><b>g<i>h</i></b> i") == "a & b c d\ne f\ngh i"
    assert out("<nav><p>menu</p></nav><article><header><h1>T</h1></header><p><b>x<br><p>y</article><footer>z</footer>tail") == "T\nx\ny"
    assert out('<div class="side bar sidebar">s</div><main><p>m</p><div id="comments"><p>c</p></div><aside>a</aside></main>') == "m"
    assert out("<script>if (a<b) x('</p>')</script><style>p{}</style><p>k</p><!-- c --><form>f<p>g</form><textarea>t</textarea>") == "k"
    assert out('<p title="a>b">1</p><p hidden>2</p><div role="navigation">3</div></div></b><p>4 &lt;b&gt; <') == "1\n4 <b> <"
    assert out("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table>") == "a\nb\nc\n1\n2\n3"
    assert out("<script>never closed <p>x</p>") == "" and out("<p>" * 3 + "q" + "<div><!-- open") == "q"


def test_html_exclusion_spares_main_text():
    out = lambda h: htmltext.extract(h, None)
    assert out('<body class="has-sidebar"><p>a</p><article class="no-comments"><p>b</p></article></body>') == "b"
    assert out('<body class="search" id="menu"><p>a</p></body>') == "a"
    assert out('<article class="related"><h2 id="related-work">Related</h2><h2 id="share">Share</h2>'
               '<section id="search-methods"><h3 id="share-prices">s</h3><p>t</p></section></article>') == "Related\nShare\ns\nt"
    assert out('<p data-id="share">1</p><p title="a hidden gem">2</p><p title="class=ad">3</p><p aria-hidden=false>4</p>') == "1\n2\n3\n4"
    assert out('<p HIDDEN>1</p><p aria-hidden="true">2</p><p id=comments>3</p><p class="x ad">4</p><p class=a class=ad>5</p>') == "5"
    assert out('<form><nav>n</nav><div class="modal">m<main><p>a</p><div class="ad">b</div></main></div></form>') == "a"
    assert out('<aside><article>teaser</article></aside><article><p>a</p></article>') == "a"
    assert out('<main><nav>n</nav></main><p>a</p>') == "a"


def test_html_templates(spark):
    rows = [(i, f"http://h.example:80/{i}", f"<html><head><title>t{i}</title></head><body><div class=x><p>Always the same</p></div>"
             f"<div class=y><p>text {i}</p><p>more {i % 2} {i}</p></div></body></html>", None, i) for i in range(8)]
    rows += [(20, "http://solo.example/", "<body><div class=x><p>Always the same</p></div><p>one</p></body>", "x", 0),
             (21, None, None, None, 0), (22, "no url", "", None, 0), (23, None, "<p>w</p>", None, 0), rows[0]]
    rows += [(40 + i, "https://copy.example/q", "<article><p>a copy</p></article>", None, 0) for i in range(9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int")
    got = Counter((r["page_id"], r["text"], r["host"]) for r in htmltext.extract_pages(frame).collect())
    expected = Counter((i, f"text {i}\nmore {i % 2} {i}", i) for i in [*range(8), 0])
    expected.update([(20, "Always the same\none", 0), (21, "", 0), (22, "", 0), (23, "w", 0)])
    expected.update((40 + i, "a copy", 0) for i in range(9))
    assert got == expected
    assert htmltext.extract_pages(frame.where("false")).count() == 0


def test_html_template_texts_inside_the_article(spark):
    story = lambda i: "".join(f"<p>story {i} part {k} of many</p>" for k in range(4))
    promo = "<div class='promo-{0} offer'><p>Take our offer</p></div>"
    rows = [(i, "http://h.example/%d" % i, f"<body><article id=post-{i}>{story(i)}<p>All rights kept</p>"
             + (promo.format(i) if i < 4 else "") + "</article></body>") for i in range(12)]
    # the same post on index, tag and archive pages, and near copies of one page, keep their text
    rows += [(20 + i, f"http://h.example/list{i}", f"<body><article id=post-50>{story(50)}</article><p>list {i}</p></body>") for i in range(3)]
    rows += [(30 + i, f"http://copy.example/{i}", f"<body><article>{story(60)}<p>read {i} times</p></article></body>") for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in htmltext.extract_pages(frame).collect()}
    lines = lambda i: [f"story {i} part {k} of many" for k in range(4)]
    expected = {i: lines(i) for i in range(12)} | {20 + i: lines(50) for i in range(3)}
    expected |= {30 + i: lines(60) + [f"read {i} times"] for i in range(4)}
    assert got == {i: "\n".join(x) for i, x in expected.items()}

    # the tags of the template decide: without them the offer is text of the whole host, on 4 of 15 pages
    tokens = htmltext.host_tokens(frame)
    template = {r["token"]: r["support"] for r in htmltext.templates(tokens).where("host = 'h.example'").collect()}
    paths, _ = htmltext.parse(rows[0][2])
    tags = {htmltext._token(p) for p in paths}
    assert tags & set(template)
    no_tags = {t: n for t, n in template.items() if t not in tags}
    assert htmltext.extract(rows[0][2], template) == got[0]
    assert htmltext.extract(rows[0][2], no_tags) == got[0] + "\nTake our offer"
    assert htmltext.extract(rows[0][2], {}) == got[0] + "\nAll rights kept\nTake our offer"


def test_html_pages_receive_only_their_template_tokens(spark):
    rows = [(i, "http://h.example/%d" % i, f"<body class=k{'abcdefghij'[i // 3]}><div><p>text {i}</p></div></body>") for i in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = htmltext.templates(htmltext.host_tokens(frame))
    assert set(found.columns) == {"host", "token", "support"}
    assert found.groupBy("host", "token").count().where("count > 1").count() == 0
    assert {r["page_id"]: r["text"] for r in htmltext.extract_pages(frame).collect()} == {i: f"text {i}" for i in range(30)}
