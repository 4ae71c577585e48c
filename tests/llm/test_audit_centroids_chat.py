"""Filter audit, centroid clustering and chat formatting against brute force, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import json
import math
import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import centroids, chat, filteraudit

RNG = random.Random(5)


# Filter interaction audit

def brute_audit(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        ws = text.encode().split()
        fails = {"A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": i is not None and i > first[text]}
        parts[lang or ""].append((i, fails))
    out = {}
    for part, rows in parts.items():
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[1][f] for r in rows) - len(gone),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in rows),
                    sum(r[0] in good for r in gone if r[0] is not None), sum(r[0] in toxic for r in gone if r[0] is not None)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(removed_by[order[step - 1]])
    return out


def audit_text(kind):
    base = [f"w{k}é" for k in range(210 if kind & 1 else 20)]
    if kind & 2:
        base = base[:5] * (len(base) // 5)
    if kind & 4:
        base = [w.upper() for w in base]
    if kind & 8:
        base.append(RNG.choice("#$%&*|"))
    return RNG.choice([" ", "\t", "\n", "\x0b", "  "]).join(base)


def test_filter_audit(spark):
    texts = [audit_text(k % 16) for k in range(60)] + [None, "", "", " ", " Ä", "ABC", "x" * 300_000 + " #", "a b " * 40_000]
    docs = [(k * 7 % 997, t, RNG.choice(["en", "de", None, ""])) for k, t in enumerate(texts)]
    docs += [(k + 1000, audit_text(3), "en") for k in range(30)] + [docs[3], docs[3], (None, texts[0], "de"), (None, "alone", None)]
    docs += [(docs[5][0], texts[5], "fr")]  # the same id and text in another part
    labels = [(i, RNG.choice([0, 1, None]), RNG.choice([0, 1])) for i in range(0, 1100, 2)] + [(0, 1, 0), (0, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, lang string, part string, code int, id int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filteraudit.audit(filteraudit.contingency(frame, marks))
    rows = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in got.collect()}
    assert rows == brute_audit(docs, labels)
    assert len(rows) == 600 * 4
    by_parts = defaultdict(int)
    for (part, order, step), v in rows.items():  # each order's removals and the rest are all documents
        by_parts[part, order] += v[1] + (v[0] if step == 5 else 0)
    assert {p: n for (p, _), n in by_parts.items()} == Counter(d[2] or "" for d in docs)


def test_filter_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(filteraudit.contingency(docs, labels)).collect() == []


def test_contraction_follows_its_selectors():
    tensor = np.arange(32).reshape(1, 1, 2, 2, 2, 2, 2)
    everything = filteraudit._contract(tensor, filteraudit._selectors(lambda at, step: filteraudit.ALL))
    assert (everything == tensor.sum()).all() and everything.shape == (1, 1, 120, 5)
    first_fails = filteraudit._contract(tensor, filteraudit._selectors(lambda at, step: filteraudit.FAIL if at == 0 else filteraudit.ALL))
    assert first_fails[0, 0, 0, 0] == tensor[0, 0, 1].sum()  # the first order begins with A


# Centroid clustering

def brute_clusters(rows, k, rounds, size, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centres = [[sum(col) // len(members[j]) for col in zip(*members[j])] if members[j] else c for j, c in enumerate(centres)]
    ends = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in ends:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((str(i), j, d, inertia[j], sum(inertia.values()), digest[j]) for i, d, j in ends)


@pytest.mark.parametrize("k, n", [(6, 200), (40, 10)])
def test_centroid_clusters(spark, k, n):
    rows = [(i, [RNG.gauss((i % 3) - 1, 0.4) for _ in range(5)]) for i in range(n)]
    rows += [rows[1], rows[1], (3, [0.0] * 5), (None, [0.5] * 5), (None, None), (n, None), (n + 1, [1.0] * 4), (n + 2, [1.0] * 6),
             (n + 3, [1.0, None, 1.0, 1.0, 1.0]), (n + 4, [1.0, float("nan"), 0.0, 0.0, 0.0]), (n + 5, [float("-inf")] + [0.0] * 4), (n + 6, [])]
    rows += [(n + 100 + i, [0.25, -0.25, 0.0, 1e4, -1e4]) for i in range(50)]  # one very common vector
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, cluster int, v double")
    got = centroids.centroid_clusters(frame, k=k, rounds=3, size=5, scale=256)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_clusters(rows, k, 3, 5, 256)


def test_equally_near_centroids(spark):
    best = spark.range(1).select(centroids.nearest(F.expr("array(0L, 0L)"), [[3, 4], [0, 5], [-5, 0], [5, 1]]).alias("b")).first()["b"]
    assert tuple(best) == (25, 0)


def test_no_vectors(spark):
    frame = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert centroids.centroid_clusters(frame, k=3, rounds=2, size=2, scale=256).collect() == []
    with pytest.raises(Exception, match="(?i)overflow"):
        far = spark.createDataFrame([(1, [1e14, 0.0]), (2, [-1e14, 0.0])], "vec_id long, embedding array<double>")
        centroids.centroid_clusters(far, k=1, rounds=1, size=2, scale=256).collect()


# Chat formatting

def turns_of(frame, key="id"):
    return {r[key]: (r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for r in frame.collect()}


RECORDS = {
    1: ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        ("messages", [("system", "s"), ("user", "q"), ("assistant", "")])),
    2: ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]},
        ("speakers", [("user", "q"), ("assistant", "a"), ("tool", "t")])),
    3: ({"instruction": "do", "input": "it", "output": "done"}, ("instruction", [("user", "do\n\nit"), ("assistant", "done")])),
    4: ({"instruction": "do", "output": "done", "extra": {"deep": [{"x": 1}]}}, ("instruction", [("user", "do"), ("assistant", "done")])),
    5: ({"prompt": "p", "completion": "c", "id": 9}, ("prompt and completion", [("user", "p"), ("assistant", "c")])),
    6: ({"prompt": "p", "response": "r", "system": "s"}, ("prompt and response", [("system", "s"), ("user", "p"), ("assistant", "r")])),
    7: ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}], "a b": 1, "x`:,<y": [[{"k": 2}]]},
        ("message parts", [("user", "ab")])),
    8: ({"data": {"prompt": "p", "response": "r"}}, ("nested pair", [("user", "p"), ("assistant", "r")])),
    9: ({"messages": []}, ("messages", [])),
    10: ({"question": "q", "context": "c", "answer": "a"}, ("question and answer", [("user", "c\n\nq"), ("assistant", "a")])),
    11: ({"title": "no layout"}, (None, [])),
    12: ({"prompt": "p", "answer": "of another layout"}, (None, [])),
    13: ({"messages": [{"role": "user", "content": "q"}], "prompt": "q"}, ("messages", [("user", "q")])),
    14: ({"turns": [{"turn": 0, "role": "user", "text": "x" * 200_000}]}, ("turn rows", [("user", "x" * 200_000)])),
    15: ([1, 2], (None, [])),
}


def test_layouts_of_json_records(spark):
    rows = [(i, json.dumps(body)) for i, (body, _) in RECORDS.items()] + [(20, None), (21, "{broken"), (22, ""), (1, json.dumps(RECORDS[1][0]))]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], "id long, body string, layout string, r int")
    out = chat.from_json(frame, "id", "body")
    assert out.count() == len(rows)
    assert turns_of(out) == {i: want for i, (_, want) in RECORDS.items()} | {20: (None, []), 21: (None, []), 22: (None, [])}
    prints = {r["id"]: r["fingerprint"] for r in out.collect()}
    assert prints[11] == prints[15] == prints[20] and prints[1] == prints[1] != prints[13] and prints[3] != prints[4]


def test_layouts_of_typed_sources(spark):
    pairs = spark.createDataFrame([(1, "p", "r"), (2, "p", None), (3, None, None)], "id long, prompt string, response string")
    lists = spark.createDataFrame([(4, [("user", "q"), (None, None)]), (5, []), (6, None)], "id long, messages array<struct<role:string,content:string>>")
    parts = spark.createDataFrame([(7, {"prompt": "p", "response": "r"})], "id long, data struct<prompt:string,response:string>")
    got = turns_of(chat.from_columns(pairs.unionByName(lists, allowMissingColumns=True).unionByName(parts, allowMissingColumns=True), "id"))
    assert got == {1: ("prompt and response", [("user", "p"), ("assistant", "r")]), 2: ("prompt and response", [("user", "p")]),
                   3: (None, []), 4: ("messages", [("user", "q"), ("", "")]), 5: ("messages", []), 6: (None, []),
                   7: ("nested pair", [("user", "p"), ("assistant", "r")])}
    assert chat.from_columns(pairs.where("false"), "id").collect() == []
    assert chat.from_columns(spark.createDataFrame([(1, 2)], "id long, x int"), "id").first()["turns"] == []


def test_mapping_is_chosen_by_the_fingerprint(spark):
    frame = spark.createDataFrame([(1, json.dumps({"prompt": "p", "response": "r"}))], "id long, body string")
    swapped = (chat.Layout("swapped", slots=(("user", ("response",)), ("assistant", ("prompt",)))),)
    assert turns_of(chat.from_json(frame, "id", "body", swapped)) == {1: ("swapped", [("user", "r"), ("assistant", "p")])}
    assert turns_of(chat.from_json(frame, "id", "body", (chat.LAYOUTS[3],))) == {1: (None, [])}


def wild_text():
    pieces = [*chat.CONTROL, *(c[0] + "\\" + c[1:] for c in chat.CONTROL), "\\", "\\\\", "<", "[", "|", ">", "s>", "\n", "é", "ok", "INST]", "", "\x00", "𝄞"]
    return "".join(RNG.choice(pieces) for _ in range(RNG.randint(0, 12)))


def test_template_is_reversible(spark):
    rows = [(c, t, RNG.choice(["user", "assistant", "system", None, wild_text()]), RNG.choice([None, wild_text(), wild_text(), wild_text()]))
            for c in range(60) for t in range(RNG.randint(1, 6))]
    rows += [(3, 0, "user", "a"), (3, 0, "user", "a"), (4, None, "assistant", "first"), (None, 0, "assistant", "x"), (None, 0, "user", "y"),
             (61, 0, "assistant", "y<s>" * 60_000), (62, 0, "assistant", chat.ATTACK)]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, turns int, safe string")
    formatted = chat.format_turns(chat.from_columns(chat.gather_turns(frame), "conv_id").withColumn("safe", F.lit(1)))
    got = sorted((r["conv_id"] is None, r["conv_id"] or 0, r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"])
                 for r in chat.digests(formatted, "conv_id").collect())
    convs = defaultdict(list)
    for k, (c, t, role, text) in enumerate(rows):
        convs[("alone", k) if c is None else c].append((-1 if t is None else t, role or "", text or ""))

    def escaped(s):
        s = s.replace("\\", "\\\\")
        for c in chat.CONTROL:
            s = s.replace(c, c[0] + "\\" + c[1:])
        return s
    want = []
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        size = sum(len(chat.START + chat.SEP + chat.END) + len(escaped(r)) + len(escaped(t)) for _, r, t in turns)
        want.append((isinstance(c, tuple), 0 if isinstance(c, tuple) else c, len(turns),
                     hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
    assert got == sorted(want)
    for r in formatted.collect():  # only the template's own marks are left
        marks = r["formatted"].count(chat.START), r["formatted"].count(chat.SEP), r["formatted"].count(chat.END)
        assert len(set(marks)) == 1 and marks[0] == len(r["loss_mask"])
        assert not any(c in r["formatted"] for c in chat.CONTROL[3:])


def test_no_conversations(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_turns(chat.from_columns(chat.gather_turns(rows), "conv_id")), "conv_id").collect() == []
