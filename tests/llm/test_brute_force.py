"""Queries without SQL, and the pipeline stage by stage, against plain-Python versions."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from conftest import rows
from test_documents import WORD, brute_components

from stacklore.llm import pii, quality, queries, sharding, toxicity
from stacklore.session import materialise

DATA = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no data folder")


def documents(folder):
    return pd.read_parquet(f"{folder}/documents.parquet").to_dict("records")


# Personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    """The patterns as they are written, with their checks."""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and plain_luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


@needs_data
@pytest.mark.parametrize("folder", [DATA, LARGER])
def test_base_spans_are_those_of_the_patterns(spark, folder):
    want = {}
    for d in documents(folder):
        spans = plain_spans(d["text"] or "")
        n = Counter(k for k, _, _ in spans)
        want[d["doc_id"]] = (*[n[k] for k in pii.KINDS], digest(spans))
    found = queries.op1_pii(spark, folder).collect()
    assert {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found} == want
    assert all(r["n_added"] == len([s for s in r["spans"].split(",") if s]) - sum(want[r["doc_id"]][:4]) for r in found)


def test_base_spans_of_random_strings():
    rng = random.Random(3)
    parts = ["a", "9", "1", "0", ".", "@", "-", " ", "+", "(", ")", "%", "x.y", "1.2.3.4", "4041894974608795", "+1 988", "é", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [(pii.LABELS[k], s, e) for k, s, e in pii.base_spans(text)] == plain_spans(text), text


def variants(rng):
    """(kind, one spelling that a pattern knows, one that none knows)."""
    number = f"{rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)}"
    user = "".join(rng.choice("abcdefgh") for _ in range(7))
    head = "".join(rng.choice("0123456789") for _ in range(15))
    card = next(head + x for x in "0123456789" if plain_luhn(head + x))
    return rng.choice([
        ("phone", f"+{rng.randint(1, 99)} {number}", number.replace(" ", "-")),
        ("email", f"{user}@mail{rng.randint(1, 9)}.example.com", f"{user}@mailhost"),
        ("card", card, "/".join(card[i:i + 4] for i in range(0, 16, 4))),
    ])


@needs_data
def test_the_field_finds_planted_variants(spark):
    """The same thing written in a way that no pattern knows, far from its known spelling."""
    table = documents(LARGER)
    weights = pii.fit(spark.read.parquet(f"{LARGER}/documents.parquet"))
    assert weights.skip > 3
    rng, found = random.Random(1), 0
    for d in rng.sample(table, 150):
        words = d["text"].split(" ")
        kind, known, other = variants(rng)
        low, high = sorted(rng.randint(0, len(words)) for _ in range(2))
        text = " ".join([*words[:low], known, *words[low:high], other, *words[high:]])
        added, rounds = pii.added_spans(text, pii.base_spans(text), weights)
        found += any(pii.LABELS[k] == kind and text[s:e] in (other, other.rstrip(".")) for k, s, e in added)
        assert rounds > 0
    assert found >= 140
    # Without its other spelling a token is judged by shape: a number that passes the cards' check may be one.
    for kind, _, other in (variants(rng) for _ in range(60)):
        added, _ = pii.added_spans(f"see {other} there", [], weights)
        assert kind == "card" or not added


def test_spans_of_odd_texts(spark):
    """Nulls, repeated rows and a long text with hits at its end."""
    long = "word " * 300_000 + "a.b@c.example.com and 10.0.0.1"
    data = [(1, None), (1, ""), (2, long), (2, long), (None, "x@y.example.com"), (3, "7" * 100_000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = rows(pii.find(df, pii.fit(df)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"))
    want = []
    for i, t in data:
        spans = plain_spans(t or "")
        n = Counter(k for k, _, _ in spans)
        want.append((i, *[n[k] for k in pii.KINDS], digest(spans)))
    assert found == sorted(want, key=repr)


def test_messages_settle_on_long_chains():
    weights = pii.Weights.from_counts({("any", k): 10 for k in range(5)}, {(0, 0): 500, (4, 4): 500})
    text = "a1@b.example.com " + " ".join(f"t{i}" for i in range(2000))
    added, rounds = pii.added_spans(text, pii.base_spans(text), weights)
    assert 0 < rounds < 2100


# Quality


def test_equal_neighbours_vote_in_their_order():
    rng = np.random.default_rng(1)
    vectors = np.repeat(rng.normal(size=(3, 6)), [400, 40, 400], axis=0)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.zeros(840)
    labels[400:400 + quality.NEIGHBOURS] = 1
    voters = quality.Voters(np.eye(6), vectors, labels, 0.5)
    assert quality.vote(vectors[400:410], voters).tolist() == [1.0] * 10
    assert quality.vote(vectors[:10], voters).max() < 0.05


@needs_data
def test_quality_votes_by_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    voters = quality.fit(docs, labels)
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, voters).collect()}
    for d in documents(DATA):
        vector = quality.terms(d["text"] or "") @ voters.weights
        vector = vector / (np.linalg.norm(vector) or 1)
        near = sorted((-round(float(c), 9), i) for i, c in enumerate(voters.vectors @ vector))[:quality.NEIGHBOURS]
        votes = [(max(-c, 0.0) ** quality.SHARPNESS, voters.labels[i]) for c, i in near]
        total = sum(w for w, _ in votes)
        want = sum(w * y for w, y in votes) / total if total else voters.prior
        assert math.isclose(found[d["doc_id"]], want, abs_tol=1e-6)


# Toxicity


def test_substitutions_at_a_word_s_end():
    automaton = toxicity.Lexicon({" garbage ": 5.0, " worthless ": 4.0, " idiot ": 4.0, " stupid ": 3.0}).automaton()
    for text, n in (("garbag3", 1), ("worthle55!", 1), ("worthle$$", 1), ("idi07", 1), ("stupid$$$", 1), ("stupid$", 1),
                    ("covid19 garbag33 garbag333", 0), ("garbag3d", 0), ("GARBAG3 g4rbag3", 2)):
        assert toxicity.features(text, automaton)[2] == n, text


def test_exceptions_are_learned(spark):
    """A pair of words that only clean documents hold cancels the entry within it."""
    data = [(i, "you nasty thing go away" if i % 2 else "the nasty weather goes on") for i in range(0, 120)]
    data += [(200 + i, "you are so nasty to me") for i in range(60)]
    data += [(300 + i, "a quiet walk in the park") for i in range(120)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("you" in t)) for i, t in data], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels, exceptions=())
    assert any("nasty weather" in e or "the nasty" in e for e in lexicon.exceptions) or " nasty " not in lexicon.weights
    scores = {t: s for (_, t), s in zip(data, [r["score"] for r in sorted(toxicity.score(docs, lexicon).collect(), key=lambda r: r["doc_id"])], strict=True)}
    assert scores["the nasty weather goes on"] < 0.3 < scores["you are so nasty to me"]


@needs_data
def test_held_out_rows_of_both_classifiers(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no data folder")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}

    def rates(query, label, of):
        held = [r for r in query(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
        of_class = [r for r in held if labels[r["doc_id"]][label] == of]
        return sum(r["predicted"] == 1 for r in of_class) / len(of_class)

    assert rates(queries.op7_toxicity, "toxic", 1) > 0.9 and rates(queries.op7_toxicity, "toxic", 0) < 0.01
    assert rates(queries.op2_quality, "quality", 1) > 0.99 and rates(queries.op2_quality, "quality", 0) < 0.08


# Mixing


def plain_mix(docs):
    """Copies per row: targets by repeated resharing, floor of the rate, one seeded draw."""
    sizes = [len(WORD.findall(d["text"] or "")) for d in docs]
    of_source = defaultdict(int)
    for d, n in zip(docs, sizes, strict=True):
        of_source[d["source"]] += n
    order = sorted(of_source, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = sum(of_source.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * of_source[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * of_source[s] for s in over}
        free -= over

    def draw(doc_id, seed):
        text = f"{'' if doc_id is None else doc_id}:{seed // 4}"
        return int(hashlib.md5(text.encode()).hexdigest()[8 * (seed % 4):8 * (seed % 4) + 8], 16) / 2**32

    copies = [0] * len(docs)
    for s in order:
        mine = [i for i, d in enumerate(docs) if d["source"] == s]
        rate = target[s] / of_source[s] if of_source[s] else 0.0
        base, part = math.floor(rate), rate - math.floor(rate)
        options = []
        for seed in range(16):
            taken = [base + (draw(docs[i]["doc_id"], seed) < part) for i in mine]
            options.append((abs(sum(n * sizes[i] for n, i in zip(taken, mine, strict=True)) - target[s]), seed, taken))
        for i, n in zip(mine, min(options)[2], strict=True):
            copies[i] = n
    return sizes, copies


@needs_data
@pytest.mark.parametrize("folder", [DATA, LARGER])
def test_mix_by_brute_force(spark, folder):
    docs = documents(folder)
    sizes, copies = plain_mix(docs)
    found = {r["doc_id"]: (r["size"], r["taken"]) for r in queries.op8_mixing(spark, folder).collect()}
    assert found == {d["doc_id"]: (n, n * c) for d, n, c in zip(docs, sizes, copies, strict=True)}


# Sharding


def plain_place(x, n, seed=0):
    """Feistel rounds over the grid, walking the cycle until inside."""
    a, b = sharding.grid(n)

    def mixed(value, key):
        v = (value + key) & sharding.MASK
        for m in sharding.MULTIPLIERS:
            v = ((v ^ (v >> 15)) * m) & sharding.MASK
        return v ^ (v >> 13)

    while True:
        left, right = x % a, x // a
        for i, key in enumerate(sharding.round_keys(seed)):
            if i % 2 == 0:
                left = (left + mixed(right, key)) % a
            else:
                right = (right + mixed(left, key)) % b
        x = right * a + left
        if x < n:
            return x


@needs_data
def test_shards_by_brute_force(spark):
    docs = documents(LARGER)
    keyed = sorted((d["doc_id"], zlib.crc32((d["text"] or "").encode()), len((d["text"] or "").encode()) + 8) for d in docs)
    want = {}
    for x, (doc_id, crc, size) in enumerate(keyed):
        place = plain_place(x, len(keyed))
        want[doc_id] = (size, crc, place % 24, place // 24)
    found = queries.op9_sharding(spark, LARGER).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found} == want


# Pipeline


def kept_ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


@needs_data
@pytest.mark.parametrize("folder", [DATA, LARGER])
def test_pipeline_stages_by_brute_force(spark, folder):
    table, stages = documents(folder), dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lexicon = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    automaton, (constant, per_log, per_density) = lexicon.automaton(), lexicon.curve
    left = []
    for d in table:
        log_weight, density, _ = toxicity.features(d["text"], automaton)
        if 1 / (1 + math.exp(-(constant + per_log * log_weight + per_density * density))) < toxicity.THRESHOLD:
            left.append(d)
    assert 0 < len(left) < len(table)

    def check(name, docs, want):
        out = materialise(stages[name](spark, docs, folder), "stage")
        assert kept_ids(out) == Counter(d["doc_id"] for d in want), name
        return out

    docs = check("toxicity", docs, left)
    best = {}
    for d in left:
        key = d["text"] or ""
        best[key] = max(best.get(key, d["doc_id"]), d["doc_id"])
    left = [d for d in left if best[d["text"] or ""] == d["doc_id"]]
    docs = check("exact_dedup", docs, left)
    component = {i: c for i, _, c in brute_components([(d["doc_id"], d["text"]) for d in left])}
    left = [d for d in left if component[d["doc_id"]] == d["doc_id"]]
    docs = check("ngram_jaccard_join", docs, left)
    _, copies = plain_mix(left)
    mixed = [d for d, n in zip(left, copies, strict=True) for _ in range(n)]
    docs = check("mixing", docs, mixed)
    pieces = stages["packing"](spark, docs, folder).collect()
    of_doc = Counter()
    for r in pieces:
        of_doc[r["doc_id"]] += r["length"] / r["doc_tokens"]
    assert {i: round(n, 6) for i, n in of_doc.items()} == {i: float(n) for i, n in Counter(d["doc_id"] for d in mixed).items()}
