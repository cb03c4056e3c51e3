"""What the line rules hold at a time."""

import random
import tracemalloc

from shelfmark.llm import bpe
from shelfmark.llm.op8_crf_rules import forget_pieces, judge_texts


def test_rules_hold_arrays_of_a_small_part_of_a_batch():
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefghijk", k=5)) for _ in range(5000)]
    texts = ["\n".join(" ".join(draw.choices(words, k=12)) for _ in range(28)) for _ in range(2500)]
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    judged = judge_texts(texts, None, 0.5)
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert len(judged["kept"]) == len(texts)
    assert peak < 30 << 20


def test_pieces_of_an_earlier_job_are_given_up(monkeypatch):
    monkeypatch.setattr(bpe, "Encoder", lambda path, spaced: object())
    bpe.encoder("some", True)
    assert bpe.encoder.cache_info().currsize
    forget_pieces()
    assert not bpe.encoder.cache_info().currsize
