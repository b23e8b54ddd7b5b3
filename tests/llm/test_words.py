"""Words that workers remember: each is encoded once, and texts come out as without memory."""

import random

import numpy as np
from pagewright.llm import packing, sentencepiece
from pagewright.llm.queries import MODEL_PATH, TOKENIZER_PATH

ODD = ["", " ", "  a  b", "a b  ", "a▁b", "\n\t x\n\n y", "日本 語🙂", "x" * 300 + " y", "\x85 \xa0 b", "it's a 'll b", "<s> <unk>"]


def texts():
    rng = random.Random(3)
    return ODD + ["".join(rng.choice("ab  ▁\n\té🙂'1中") for _ in range(rng.randint(0, 40))) for _ in range(300)]


def test_each_word_is_encoded_and_decoded_once(monkeypatch):
    asked = []
    encode_words, decode = sentencepiece.encode_words, sentencepiece.decode
    monkeypatch.setattr(sentencepiece, "encode_words", lambda words, table: asked.extend(words) or encode_words(words, table))
    monkeypatch.setattr(sentencepiece, "decode", lambda ids, table: 1 / 0)
    monkeypatch.setattr(sentencepiece, "KNOWN_WORDS", 3)
    table = sentencepiece.load(MODEL_PATH)
    for some in (["one two"], ["one three four"], ["one five"], ["five one six"]):
        ids, same = sentencepiece.encode_texts(some, table)
        assert same == [True] and [decode(i, table) for i in ids] == some
    assert asked.count("▁one") == 1 and len(table.known) <= 3 and len(table.older) <= 3


def test_texts_with_and_without_memory_are_alike():
    table = sentencepiece.load(MODEL_PATH)
    once, same = sentencepiece.encode_texts(texts(), table)
    assert same == ["▁" not in t for t in texts()] == [sentencepiece.decode(i, table) == t for i, t in zip(once, texts(), strict=True)]
    again, _ = sentencepiece.encode_texts(texts(), table)
    assert all(np.array_equal(a, b) for a, b in zip(once, again, strict=True))


def test_pieces_that_lose_a_character_are_decoded():
    pieces = sentencepiece.Pieces(["<unk>", "▁", "a", "▁a"], [0.0, -1.0, -2.0, -3.0], [2, 1, 1, 1], sentencepiece.BPE)
    _, same = sentencepiece.encode_texts(["a a", "a b", ""], pieces)
    assert same == [True, False, True]


def test_units_without_offsets_give_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(packing, "MAX_UNITS", 20)
    with open(TOKENIZER_PATH, encoding="utf-8") as file:
        encoder = packing._Encoder(file.read())
    for text in texts() + texts()[::-1]:
        plain = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), dtype="<u4").tolist() == plain
    assert not any(unit.startswith(" ") for unit in encoder.known)
