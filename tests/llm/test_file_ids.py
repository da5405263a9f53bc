"""Ids of a tokenizer file against the tokenizer itself, for every character and for odd texts."""

from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rillstone.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def same(tokenizer, text):
    return tokens.file_ids(PATH)(text) == array("i", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_every_character_in_every_place(tokenizer):
    for base in range(0, 0x110000, 8192):
        text = "".join(f"a{c}1 {c}b{c}{c} {c}!\n{c}  {c}" for c in map(chr, range(base, base + 8192)) if not 0xD800 <= ord(c) <= 0xDFFF)
        assert not text or same(tokenizer, text), hex(base)


@pytest.mark.parametrize("text", [
    "", " ", "   ", "a  b   c ", "\t\n\r\n \n", "it's we'll I'd 'S", "x" * 5000, " " * 3000 + "y", "12 345  6", "日本語 テキスト", "é" * 999,
    "<|endoftext|>", "a <|endoftext|> b", "<|endoftext", "\x00\x01 \x7f\x85\xa0x"])
def test_odd_texts(tokenizer, text):
    assert same(tokenizer, text)


def test_no_text():
    assert tokens.file_ids(PATH)(None) == b""


def test_other_files_go_through_the_tokenizer(tmp_path):
    from tokenizers import models, pre_tokenizers

    made = Tokenizer(models.BPE(vocab={"a": 0, "b": 1, "ab": 2}, merges=[("a", "b")]))
    made.pre_tokenizer = pre_tokenizers.Whitespace()
    made.save(str(tmp_path / "t.json"))
    assert tokens.file_ids(str(tmp_path / "t.json"))("ab ba") == array("i", [2, 1, 0]).tobytes()
