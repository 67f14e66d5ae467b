"""Conversation trie, URL filter and ranked search: defined cases and brute-force versions."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows

from stacklore.llm import prefix_trie, queries, term_pipeline, url_filter

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no data folder")


# Trie of conversations


def plain_trie(turns):
    """Nodes by dictionaries of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c, held in own.items():
        def place(t):
            named = f"{len(t[2].encode())}:{t[2]}{t[3]}"
            return (t[0], t[1], hashlib.sha256(named.encode()).hexdigest()[:32])
        own[c] = [t[2:] for t in sorted(held, key=place)]
    rebuilt = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + path[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    found = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        found.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                      hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


TURNS = "conv_id long, turn int, role string, text string"


@needs_data
@pytest.mark.parametrize("shard_turns", [200_000, 12])
def test_trie_of_the_table(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard_turns)
    table = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = plain_trie([tuple(r) for r in table.collect()])
    assert rows(queries.op11_prefix_trie(spark, DATA)) == want


def random_turns(seed, conversations=120):
    """Few texts, long shared spines, copies, and prefixes of one another."""
    rng = np.random.default_rng(seed)
    spine = [("user", f"s{i}") for i in range(40)]
    turns = []
    for c in range(conversations):
        kind = rng.integers(4)
        if kind == 0:
            path = spine[:rng.integers(1, 41)]
        elif kind == 1:
            path = spine[:rng.integers(0, 20)] + [("a", str(rng.integers(3))) for _ in range(rng.integers(1, 4))]
        elif kind == 2:
            path = [("user", "é" * int(rng.integers(3)))] * int(rng.integers(1, 4))
        else:
            path = spine[:7]
        turns += [(c, i, *t) for i, t in enumerate(path)]
    return turns


@pytest.mark.parametrize(("seed", "shard_turns", "block"), [(1, 10, 4), (2, 50, 64), (3, 5, 2), (4, 10_000, 4)])
def test_trie_of_random_conversations(spark, monkeypatch, seed, shard_turns, block):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 8)
    turns = random_turns(seed)
    assert rows(prefix_trie.conversation_trie(spark.createDataFrame(turns, TURNS))) == plain_trie(turns)


def test_trie_of_odd_conversations(spark):
    long = "lang " * 100_000
    data = [(5, None, "user", "a"), (5, 0, None, "b"), (5, 1, "user", None), (6, 3, "u", "x"), (6, 3, "u", "w"), (6, 3, "u", "x"),
            (7, 0, "u", long), (None, 0, "u", "x"), (11, 0, "", ""), (12, 0, None, None), (14, 1, "u", "only")]
    df = spark.createDataFrame(
        [(*r, b"k", b"p", 1, "s") for r in data],
        TURNS + ", key binary, path binary, shard int, base string",
    )
    assert rows(prefix_trie.conversation_trie(df)) == plain_trie(data)
    assert prefix_trie.conversation_trie(df.limit(0)).count() == 0


def test_parentheses_close_where_a_stack_says():
    rng = np.random.default_rng(5)
    for nodes in (1, 2, 63, 64, 65, 3000):
        bits, open_now, left = [], 0, nodes
        while left or open_now:
            opening = left and (not open_now or rng.random() < 0.55)
            bits.append(int(bool(opening)))
            open_now, left = (open_now + 1, left - 1) if opening else (open_now - 1, left)
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        tree = prefix_trie.Parentheses(np.array(bits, np.uint8))
        assert tree.findclose().tolist() == [close[i] for i in tree.opens.tolist()]
        assert tree.leaf_pairs().sum() == sum(close[i] == i + 1 for i in close)


# URL filter


def plain_parts(url):
    found = re.search("://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (found[1], found[2]) if found else ("", "")
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def plain_g(a, b, c, d):
    total, out = c + d, 0.0
    for x, y in ((a, b), (c - a, d - b)):
        for seen, column in ((x, c), (y, d)):
            out += seen * math.log(seen * total / ((x + y) * column)) if seen else 0
    return 2 * out


def plain_judge(urls, rules):
    """Templates by walking every host's paths level by level."""
    parts = [plain_parts(u) for u in urls]
    ruled = [plain_rule(*p, rules) for p in parts]
    counts = defaultdict(lambda: np.zeros(3, int))
    for p, r in zip(parts, ruled, strict=True):
        counts[p] += [1, r is not None and r.verdict == "allow", r is not None and r.verdict == "block"]
    template = dict.fromkeys(counts, "")
    segments = {p: p[1].split("/")[1:] for p in counts}
    for level in range(url_filter.DEPTH):
        branch, classes = defaultdict(lambda: np.zeros(3, int)), defaultdict(dict)
        for p, n in counts.items():
            if level < len(segments[p]):
                s = segments[p][level]
                shape = next((name for name, pattern in url_filter.SHAPES if re.search(pattern.replace(r"\z", r"\Z"), s)), "word")
                branch[p[0], template[p], shape, s] += n
        for key, n in branch.items():
            classes[key[:3]][key[3]] = n
        grown = {}
        for p in counts:
            if level < len(segments[p]):
                s = segments[p][level]
                shape = next((name for name, pattern in url_filter.SHAPES if re.search(pattern.replace(r"\z", r"\Z"), s)), "word")
                values = classes[p[0], template[p], shape]
                n, (_, clean, bad) = values[s], sum(values.values())
                variable = len(values) >= url_filter.MANY and n[0] < url_filter.FEW
                merged = len(values) > 1 and (variable or plain_g(n[1], n[2], clean, bad) < url_filter.G_LIMIT)
                grown[p] = template[p] + (f"/*{shape}" if merged else f"/={s}")
        template |= grown
    for p in counts:
        template[p] += "/**" if len(segments[p]) > url_filter.DEPTH else ""
    _, clean, bad = sum(counts.values())
    overall = clean / (clean + bad) if clean + bad else 1.0
    by_host, by_template = defaultdict(lambda: np.zeros(3, int)), defaultdict(lambda: np.zeros(3, int))
    for p, n in counts.items():
        by_host[p[0]] += n
        by_template[p[0], template[p]] += n

    def purity(p):
        (_, hc, hb), (_, c, b) = by_host[p[0]], by_template[p[0], template[p]]
        host = (hc + 4 * overall) / (hc + hb + 4)
        return (c + 4 * host) / (c + b + 4)

    return [(*p, r and r.name, r.verdict if r else "block" if purity(p) < 0.5 else "allow", template[p], round(purity(p), 9))
            for p, r in zip(parts, ruled, strict=True)]


def judged(df):
    return sorted(((*r[:6], round(r[6], 9)) for r in df.collect()), key=repr)


@needs_data
@pytest.mark.parametrize("folder", [DATA, "/root/testdata/sf0.01"])
def test_urls_of_the_table(spark, folder):
    table = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()
    want = plain_judge([r["url"] for r in table], queries.RULES)
    got = judged(queries.op12_url_filter(spark, folder))
    assert got == sorted(((r["page_id"], *w) for r, w in zip(table, want, strict=True)), key=repr)
    assert {w[3] for w in want} == {"allow", "block"}


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.ORG/es/x", "x://example.org/en/1?q=://a", "http://org", "http://org/",
            "http://notorg/a", "http://u@h:80/" + "a/" * 30, "http://h/b\nc#f", "http://h/" + "z" * 100_000, "http://h//", "http://h/=/*word",
            "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/de/1"]
    urls += [f"http://shop.com/{'good' if i % 2 else 'bad'}/{i}" for i in range(40)]
    data = [(i if i % 7 else None, u, "h", "t", "r", 1) for i, u in enumerate(urls)]
    df = spark.createDataFrame(data, "page_id long, url string, host string, template string, rule string, rows int")
    want = plain_judge(urls, queries.RULES)
    assert judged(url_filter.judge(df, queries.RULES)) == sorted(((d[0], *w) for d, w in zip(data, want, strict=True)), key=repr)
    assert url_filter.judge(df.limit(0), queries.RULES).count() == 0


def test_labelled_branches_stay_apart(spark):
    data = [(i, f"http://h/{'spam' if i % 3 == 0 else ('news', 'text')[i % 2]}/{i}") for i in range(300)]
    df = spark.createDataFrame(data, "page_id long, url string")
    from pyspark.sql import functions as F

    known = F.when(F.col("page_id") < 150, ~F.col("url").contains("spam"))
    found = {r["page_id"]: (r["verdict"], r["template"]) for r in url_filter.judge(df, (), known).collect()}
    assert all(found[i] == (("block", "/=spam/*number") if i % 3 == 0 else ("allow", found[i][1])) for i in found)
    assert len({t for v, t in found.values() if v == "allow"}) <= 2


# Ranked search


def plain_search(documents, items, k=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def words(text):
        return term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counted = [(i, Counter(words(t))) for i, t in documents]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, n_words = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    found = []
    for item, text in set(items):
        asked = set(words(text))
        scores = []
        for at, (i, c, n) in enumerate(counted):
            m = 10 + 90 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in asked if t in c)
            if score > 0:
                scores.append((-score, i is not None, i or 0, at))
        found += [(item, rank + 1, i if has else None, -s) for rank, (s, has, i, _) in enumerate(sorted(scores)[:k])]
    return sorted(found, key=repr)


@pytest.mark.parametrize(("block", "postings"), [(4096, 1 << 20), (16, 1 << 20), (4096, 50)])
def test_search_with_many_blocks(spark, monkeypatch, block, postings):
    monkeypatch.setattr(term_pipeline, "BLOCK_DOCS", block)
    monkeypatch.setattr(term_pipeline, "BLOCK_POSTINGS", postings)
    rng = np.random.default_rng(block + postings)
    vocabulary = [f"w{i}" for i in range(60)]
    chance = 1 / np.arange(1, 61)
    chance /= chance.sum()
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 30), p=chance))) for i in range(400)]
    docs += [(400 + i, docs[3][1]) for i in range(60)]  # copies tie
    items = [(i, " ".join(rng.choice(vocabulary, 6))) for i in range(12)]
    found = term_pipeline.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    )
    assert rows(found) == plain_search(docs, items)


def test_search_in_bundles(spark, monkeypatch):
    monkeypatch.setattr(term_pipeline, "BUNDLE_BYTES", 20)
    docs = [(i, f"common w{i % 4} w{i % 7}") for i in range(50)]
    items = [(i, f"w{i} common unknown") for i in range(7)]
    found = term_pipeline.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 3)
    assert rows(found) == plain_search(docs, items, 3)


def test_search_of_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "-- !"), (4, "Straße ÉTÉ été\u00a0x"), (5, "été"), (5, "été"), (None, "été two"), (6, "two\u2028Two 2x"),
            (7, "long " * 200_000 + "two"), (8, "one")]
    items = [(1, "ÉTÉ été"), (1, "two"), (1, "two"), (2, None), (3, ""), (None, "TWO straße"), (4, "unknown"), (5, "long long one")]
    extra = ", slot int, block long, n int, terms string, item int, total int, score string, rank int"
    df = spark.createDataFrame([(*d, 0, 0, 0, "", 0, 0, "", 0) for d in docs], "doc_id long, text string" + extra)
    asked = spark.createDataFrame([(*i, 0, 0, 0, "", 0, 0, "", 0) for i in items], "item_id long, text string" + extra)
    assert rows(term_pipeline.search(df, asked)) == plain_search(docs, items)
    assert term_pipeline.search(df.limit(0), asked).count() == 0
    assert term_pipeline.search(df, asked.limit(0)).count() == 0
