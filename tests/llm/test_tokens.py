"""Whole texts by cached parts: the ids of the tokenizers library, known parts looked up without Python code."""

import public_tokenizers
import pytest

from fleetlens.llm.tokens import CorpusEncoder

TEXTS = ("", " ", "a  b", "Hello, hello world. x", "a\x1cb c", "a\xa0b.", "\x85x", "\u00e9. \u00c9, \u00aa\u00ba. a\u2003b", "x\x01y \x01", "\u3000a.",
         "don't a.. . I'll", "\u00c0B! \u00df? \u00b5m; \u00bd. \u00b2,", "12 3a a3 .", "\u65e5\u672c \u0434\u0430.", "<|endoftext|> x", "tab\tnew\nline\x0bx")


@pytest.mark.parametrize("kind, name", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_ids_are_those_of_the_library(kind, name):
    enc = CorpusEncoder(public_tokenizers.path(name), kind)
    for text in TEXTS * 2:
        assert enc.encode(text) == enc._whole(text), text


def test_only_parts_not_held_are_encoded():
    enc, made = CorpusEncoder(public_tokenizers.path("word_bpe_49k.json"), "word"), []
    encode = enc.parts.encode
    enc.parts.encode = lambda part: (made.append(part), encode(part))[1]
    enc.encode("one two three")
    enc.encode("one two three four one")
    assert made == ["one", "two", "three", "four"]
