"""Reply trees, periodic runs and ranked search against brute force and on odd input."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA

from check import rows_of
from shelfmark.llm import op11_reply_trees as trees
from shelfmark.llm import op12_grammar_runs as grammar
from shelfmark.llm import op13_rmq_search as search
from shelfmark.llm.words import documents

MESSAGES = "tree long, node long, parent long, role string, text string, score double, path string, depth int"


def plain_conversations(rows, best):
    """{(tree, rank): (texts, mean score)} by following every leaf up."""
    key = lambda x: (x is not None, x)
    rows = sorted(set(rows), key=lambda r: [key(r[i]) for i in (0, 1, 3, 4, 2)])
    first = {}
    for i, r in enumerate(rows):
        if r[1] is not None:
            first.setdefault((r[0], r[1]), i)
    up = {i: first.get((r[0], r[2])) if r[2] is not None else None for i, r in enumerate(rows)}
    up = {i: None if u == i else u for i, u in up.items()}

    def line(i):
        seen = []
        while i is not None:
            if i in seen:
                return None
            seen.append(i)
            i = up[i]
        return seen[::-1]

    circling = [i for i in up if line(i) is None]
    up |= dict.fromkeys(circling)
    leaves = collections.defaultdict(list)
    for i in set(up) - set(up.values()):
        path = line(i)
        score = sum(rows[j][5] or 0.0 for j in path) / len(path)
        leaves[rows[i][0]].append((-score, -len(path), i, [(rows[j][3], rows[j][4]) for j in path]))
    out = {}
    for tree, found in leaves.items():
        for rank, (score, _, _, path) in enumerate(sorted(found)[:best], 1):
            out[tree, rank] = (path, round(-score, 9))
    return out


def shown(role, text):
    mask = lambda x: (x or "").replace("\\", "\\\\").replace("#", "\\#").replace("</turn>", "\\</turn>")
    name = mask(role).replace(":", "\\:").replace("\n", "\\\n")
    return f"### {name}:\n{mask(text)}</turn>\n"


def joined(parts):
    """(text, learned texts) of each conversation, from its parts."""
    out = collections.defaultdict(lambda: ["", []])
    for r in sorted(parts.collect(), key=lambda r: (r.path, r.part)):
        at = out[r.tree, r.rank]
        at[0] += r.text
        at[1] += [trees.unescaped(r.text[s.start : s.end]) for s in r.loss]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_equal_plain_paths(spark, seed):
    rng = random.Random(seed)
    texts = ["", None, "a", "### assistant:\nx</turn>\n", "\\", "\\</turn>", "</turn", "née 日本 \U0001f600", "#", "<", "\\\\#"]
    rows = []
    for tree in [*range(12), None]:
        for node in range(rng.choice([1, 2, 9, 30])):
            parent = rng.choice([None, node, rng.randrange(40), max(0, node - 1), max(0, node - 1)])
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None, "a:b\n\\"]), rng.choice(texts), rng.choice([None, 0.25, 0.5, 2.0])))
    rows += rows[:3] + [(3, None, 0, "assistant", "no node", 9.0), (3, 1, 0, "user", "second of a node", 1.0)]
    rows += [(50, i, (i + 1) % 5, "user", f"circle {i}", 1.0) for i in range(5)] + [(50, 7, 2, "assistant", "below", 1.0)]
    found = trees.format_replies(spark.createDataFrame([(*r, "p", 1) for r in rows], MESSAGES), best=3)
    plain = plain_conversations(rows, 3)
    got = joined(found)
    assert set(got) == set(plain)
    for at, (path, _) in plain.items():
        assert got[at][0] == "".join(shown(*turn) for turn in path)
        assert got[at][1] == [t or "" for role, t in path if role == "assistant"]
    scores = {(r.tree, r.rank): round(r.score, 9) for r in found.collect()}
    assert scores == {at: score for at, (_, score) in plain.items()}


def test_long_chains_go_in_parts(spark):
    turns = [(1, i, ("user", "assistant")[i % 2], f"text {i} </turn>" if i else None) for i in range(300)] + [(2, 5, "assistant", "x"), (2, 5, "assistant", "x")]
    parts = trees.format_turns(spark.createDataFrame(turns, "c long, turn long, role string, text string"), "c", ["turn"])
    assert parts.groupBy("tree").count().where("tree = 1").first()["count"] == math.ceil(300 / trees.PART_TURNS)
    read = {r.tree: r for r in trees.read_conversations(parts).collect()}
    for tree, mine in ((1, turns[:300]), (2, turns[300:])):
        learned = "".join(t for _, _, role, t in mine if role == "assistant")
        assert read[tree].n_turns == len(mine) and read[tree].loss_chars == len(learned)
        assert read[tree].turns_sha256 == hashlib.sha256("".join(f"{role}\n{t or ''}\n" for _, _, role, t in mine).encode()).hexdigest()
        assert read[tree].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert read[tree].formatted_chars == sum(len(shown(role, t)) for _, _, role, t in mine)


def test_conversations_equal_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{TESTDATA}/conversations.parquet'")
    ours = trees.op11_reply_trees(spark, str(TESTDATA)).toPandas()
    assert rows_of(ours) == rows_of(db.execute(trees.SQL).df())


def test_trees_of_no_rows(spark):
    none = spark.createDataFrame([], MESSAGES)
    assert trees.format_replies(none).collect() == []
    assert trees.read_conversations(trees.format_turns(none, "tree", ["node"])).collect() == []


def test_what_is_no_conversation_is_refused(spark):
    bad = spark.createDataFrame([(1, 1, 1, 0, "### a:\nx</turn>\nrest", [])], "tree long, path long, depth long, part int, text string, loss array<struct<start: int, end: int>>")
    with pytest.raises(Exception, match="not a formatted conversation"):
        trees.read_conversations(bad).collect()


# ------------------------------------------------------------------ periodic runs


def slow_runs(words):
    """All runs (start, length, period) by the definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def slow_digest(doc_id, words):
    runs = slow_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (r[1] * math.factorial(12) // r[2] if r[2] <= 12 else r[1] * math.factorial(12) / r[2], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(left))


def random_texts(rng, n):
    out = []
    for _ in range(n):
        k, size = rng.choice([1, 2, 3, 5, 60]), rng.choice([0, 1, 5, 6, 7, 23, 80, 200])
        words = [f"w{rng.randrange(k)}" for _ in range(size)]
        if size > 4 and rng.random() < 0.6:
            a = rng.randrange(size)
            p = 1 + (size - a) // rng.randint(3, 10)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
        out.append(rng.choice([" ", "\n", " \t\v "]).join(words))
    return out


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        texts = random_texts(rng, rng.randint(1, 12))
        _, runs, _ = grammar.find_runs(texts)
        for text, found in zip(texts, runs, strict=True):
            assert [(r["start"], r["length"], r["period"]) for r in found] == slow_runs(text.split())


def test_runs_when_hashes_lie(monkeypatch):
    monkeypatch.setattr(grammar.Ranges, "equal", lambda self, a, b, size: np.ones(len(a), bool))
    texts = random_texts(random.Random(9), 60)
    _, runs, _ = grammar.find_runs(texts)
    for text, found in zip(texts, runs, strict=True):
        assert [(r["start"], r["length"], r["period"]) for r in found] == slow_runs(text.split())


def test_grammar_derives_the_texts(monkeypatch):
    texts = [*random_texts(random.Random(3), 40), "a b c " * 500, "x " * 3000]
    ids = [grammar.text_words(t, grammar.Numbers()) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
    flat = np.concatenate(ids)
    _, symbols = np.unique(np.repeat(np.arange(len(ids)), np.diff(offsets)) * (flat.max() + 1) + flat, return_inverse=True)
    made = grammar.Grammar(symbols, offsets)
    for text, root in enumerate(made.roots.tolist()):
        out, stack = [], [root] if root >= 0 else []
        while stack:
            s = stack.pop()
            if made.left[s] < 0:
                out.append(s)
            else:
                stack += [made.right[s], made.left[s]]
        assert out == symbols[offsets[text] : offsets[text + 1]].tolist()
    assert made.n - made.n_words < 4 * len(flat) // 3
    repeated = made.roots[-1]
    inside = {repeated}
    for s in range(made.n - 1, made.n_words - 1, -1):
        if s in inside:
            inside |= {made.left[s], made.right[s]}
    assert len(inside) < 60  # 3000 equal words


def test_small_blocks_of_candidates(monkeypatch):
    texts = ["a b c d e f g h i j " * 40, "x " * 100, "p q r " * 30]
    whole = grammar.find_runs(texts)
    monkeypatch.setattr(grammar, "CANDIDATES", 7)
    monkeypatch.setattr(grammar, "PIECE", 5)
    monkeypatch.setattr(grammar, "PORTION", 50)
    assert grammar.find_runs(texts) == whole


def test_run_digests_equal_brute_force(spark):
    want = {}
    for r in documents(spark, str(TESTDATA)).select("doc_id", "text").collect():
        words = re.findall("[^\x20\x09-\x0d]+", r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n < 1500:
            want[r.doc_id] = slow_digest(r.doc_id, words)
    got = {r[0]: tuple(r) for r in grammar.op12_grammar_runs(spark, str(TESTDATA)).collect()}
    assert len(got) == 200 and {d: got[d] for d in want} == want
    assert sum(r[1] > 0 for r in want.values()) > 5


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "b " * 5), (5, "w " * 200_000), (6, "née 日本 " * 4)]
    odd = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, runs int, start string, best int")
    found = grammar.periodic_runs(odd)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"), (None, 5, [], "b b b b b"), (5, 200_000, [(0, 200_000, 1)], "w"), (6, 8, [(0, 8, 2)], "née 日本")]
    assert got == sorted(want, key=repr)
    assert grammar.periodic_runs(odd.where("false")).collect() == []
    planted = grammar.with_planted_runs(odd)
    assert planted.count() == len(rows) and planted.where("doc_id IS NULL").first().text == "b " * 5


# ------------------------------------------------------------------ ranked search


def plain_search(docs, items, top):
    """(item, rank, doc, score) by scoring every document."""
    held = [(d, collections.Counter(search.phrase_words(t))) for d, t in docs]
    full = [(d, c) for d, c in held if c]
    n_docs, total = len(full), sum(c.total() for _, c in full)
    df = collections.Counter(t for _, c in full for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, c in full:
            m = 75 + 25 * c.total() * n_docs // total
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in collections.Counter(search.phrase_words(text)).items() if c[t])
            if score > 0:
                scores.append((-score, d is None, d, score))
        out += [(item, i, d, s) for i, (_, _, d, s) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def test_search_equals_sql(spark):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/{t}.parquet'")
    ours = search.op13_rmq_search(spark, str(TESTDATA)).toPandas()
    assert rows_of(ours) == rows_of(db.execute(search.SQL).df())


@pytest.mark.parametrize("block_bytes", [40, 1 << 20])
def test_search_equals_brute_force(spark, block_bytes):
    rng = random.Random(block_bytes)
    docs = [(i, " ".join(rng.choice(["the", "of", "And", "x1", "née", f"r{rng.randrange(30)}"]) for _ in range(rng.choice([0, 1, 4, 30])))) for i in range(150)]
    docs += [(i, docs[7][1]) for i in range(150, 190)] + [(7, docs[7][1]), (None, "the r1 r2"), (200, None), (201, "..."), (202, "r3 " * 20_000)]
    items = [(1, "The r1 r2, r2 and of"), (2, docs[7][1]), (3, None), (4, "never-seen"), (5, ""), (1, "The r1 r2, r2 and of"), (6, "r3 x1"), (None, "née")]
    table = spark.createDataFrame([(d, t, 5, 6, 7) for d, t in docs], "doc_id long, text string, n int, rank int, terms int").repartition(3, "doc_id")
    asked = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, score int, item int")
    found = search.search_documents(table, asked, top=9, block_bytes=block_bytes)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_search(docs, [i for i in items if i[1]], 9)
    assert search.search_documents(table.where("false"), asked).collect() == []
    assert search.search_documents(table, asked.where("false")).collect() == []


def test_search_of_a_shard_skips_documents(monkeypatch):
    rng = np.random.default_rng(4)
    n, n_terms = 20_000, 12
    docs, terms = np.nonzero(rng.random((n, n_terms)) < np.linspace(0.4, 0.0005, n_terms))
    impacts = rng.integers(1, 50, len(docs)) * (terms + 1)
    shard = search.Shard(np.arange(n) * 3, docs, terms, impacts)
    times = rng.integers(1, 3, n_terms)
    scores = np.bincount(docs, impacts * times[terms], n).astype(int)
    want = sorted((-s, 3 * d) for d, s in enumerate(scores.tolist()) if s)[:20]
    for width in (1, 64):
        monkeypatch.setattr(search, "WIDTH", width)
        best = search.Best(20)
        scored = shard.search(np.arange(n_terms), times, best)
        assert [(-s, d) for s, d in zip(best.scores.tolist(), best.doc_ids.tolist(), strict=True)] == want
        assert scored < n // 4


def test_range_maxima():
    rng = np.random.default_rng(1)
    impacts = rng.integers(0, 9, 300)
    shard = search.Shard(np.arange(300), np.arange(300), np.zeros(300, np.int64), impacts)
    begin, end = rng.integers(0, 300, (2, 500))
    some = begin < end
    found = shard.place_of_largest(begin[some], end[some])
    assert found.tolist() == [b + int(np.argmax(impacts[b:e])) for b, e in zip(begin[some], end[some], strict=True)]
