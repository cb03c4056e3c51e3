"""The bound by which pairs of lines are left out before their words are compared."""

from __future__ import annotations

import random

from shelfmark.llm.op9_line_join import _missing


def test_prefix_bound_of_lines_loses_no_similar_pair(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        x = rng.sample(range(400), rng.choice([6, 20, 60, 120]))
        # Tokens may stand for two words: // 2 makes such.
        y = [w if rng.random() > rng.choice([0.02, 0.1, 0.3]) else 400 + w for w in x]
        kept = lambda n: -(-40 * n // 100) + 2
        xt, yt = sorted(w // 2 for w in x), sorted(w // 2 for w in y)
        rows.append((len(rows), len(x), xt[: kept(len(x))], len(y), yt[: kept(len(y))], 180 * len(set(x) & set(y)) >= 80 * (len(x) + len(y))))
    pairs = spark.createDataFrame(rows, "k int, xn int, xp array<int>, yn int, yp array<int>, similar boolean")
    left = {r.k for r in _missing(pairs).collect()}
    alike = {r[0] for r in rows if r[-1]}
    assert alike and alike <= left and len(left) < len(rows)
