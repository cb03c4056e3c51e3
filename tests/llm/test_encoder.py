"""The shared encoder: each word is merged once, and ids are those of the tokenizers library."""

import numpy as np
import pytest

from shelfmark.llm.bpe import Encoder, tokenizer_path


class CountingModel:
    def __init__(self, model):
        self.model, self.seen = model, []

    def tokenize(self, word):
        self.seen.append(word)
        return self.model.tokenize(word)


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_word_is_merged_once_whatever_marks_follow(name, spaced):
    encoder = Encoder(tokenizer_path(name), spaced)
    encoder.model = CountingModel(encoder.model)
    texts = ["x strange strange. strange, strange!! strange$$$", "x strange.&&& (strange) strange\nstrange###"]
    raw = encoder.encode(texts)
    words = [w for w in encoder.model.seen if "strange" in w]
    assert len(words) == len(set(words)) <= 2  # with a space before it, and without
    for text, ids in zip(texts, raw, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_of_odd_white_space_and_marks(name, spaced):
    encoder = Encoder(tokenizer_path(name), spaced)
    texts = ["", " ", "\n", "a\n", "\na", " a", "a ", "a  b", "a \nb", "a\n b", "a\n\n\nb.", "\ta\t b\r\n", "it's 'a' a'b", "a<b a_b a^*", "<|endoftext|>a", "\x1da", "\x1d a", "a\x1d", "É.é! x1.", "á b"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
