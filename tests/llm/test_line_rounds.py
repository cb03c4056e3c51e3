"""Near copies that are not similar to the first of their group."""

from __future__ import annotations

import random

from shelfmark.llm import op9_line_join as join


def test_most_of_a_crowd_is_settled_before_all_its_pairs_are_asked(spark, monkeypatch):
    pick = random.Random(5)
    base = [f"word{i}" for i in range(40)]
    texts = [" ".join(base)]
    for i in range(300):
        line = [w if pick.random() > 0.12 else f"{w}x{pick.randrange(3)}" for w in base]
        texts.append(" ".join(line))
    sets = [set(t.split()) for t in texts]
    similar = lambda a, b: 180 * len(a & b) >= 80 * (len(a) + len(b))
    want = {i for i, s in enumerate(sets) if any(similar(s, sets[j]) for j in range(i))}
    # Lines of words of their own, beside which the crowd is a small part.
    texts += [" ".join(f"own{i}x{k}" for k in range(8)) for i in range(2500)]
    counts, verified = [], join._verified

    def counted(pairs, *rest):
        counts.append(pairs.distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(join, "_verified", counted)
    out = join.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id for r in out.where("n_removed > 0").collect()} == want
    assert 30 < len(want) < 270
    assert counts[-1] < 2500
