"""Long lines that share rare words and little else are told apart before their pairs are joined."""

import random

from shelfmark.llm import op9_line_join as join
from shelfmark.llm.op9_line_join import dedup_lines


def long_lines():
    """Ten rare words in every line, which make equal pairs of tokens, among ninety of its own. The
    tokens of the last line are all but a few of the first one's."""
    draw = random.Random(5)
    lines = [[f"rare{k}" for k in range(10)] + [f"w{draw.randrange(3000)}" for _ in range(90)] for _ in range(60)]
    common = " ".join([f"w{k}" for k in range(3000)] * 100)  # the other words are frequent
    return [common, *[" ".join(x) for x in lines], " ".join(lines[0][:-4] + ["other"])]


def test_long_lines_that_share_rare_words_are_no_candidates(spark, monkeypatch):
    counts, verified = [], join._verified

    def counted(pairs, classes, docs):
        counts.append(pairs.distinct().count())
        return verified(pairs, classes, docs)

    monkeypatch.setattr(join, "_verified", counted)
    lines = long_lines()
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    removed = [r.doc_id for r in dedup_lines(docs).where("n_removed > 0").collect()]
    assert removed == [len(lines) - 1]
    assert sum(counts) < 100  # of 60 * 59 / 2 pairs


def test_parts_of_the_keys_make_no_difference(spark, monkeypatch):
    lines = long_lines() + ["one two three four five six", "one two three four five six seven", "a b c d e"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = []
    for parts in (1, 2, 8):
        monkeypatch.setattr(join, "KEY_PARTS", parts)
        found.append(sorted(r.doc_id for r in dedup_lines(docs).where("n_removed > 0").collect()))
    assert found[0] == found[1] == found[2] == [61, 63]
