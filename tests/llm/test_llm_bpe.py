"""The tokenizer's work for each text and word, and its results at the bounds of what it remembers."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from panelkit.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def automaton():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def _same(own, library, text):
    ids = np.frombuffer(own.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids, text[:80]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), text[:80]


def test_a_text_is_split_once(automaton, library):
    own, calls = bpe.Tokenizer(automaton), Counter()
    find = own.find

    def counted(text):
        calls["find"] += 1
        return find(text)

    own.find = counted
    text = " ".join(f"{a}é{b}{c}" for a in "abcde" for b in "VWXYZ" for c in (".", ",", "!", "", "'s"))
    _same(own, library, text)
    assert calls["find"] == 1


def test_frequent_words_are_not_forgotten(automaton, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER_WORDS", 10)
    own, calls = bpe.Tokenizer(automaton), Counter()
    encode = own.encode_word

    def counted(word):
        calls[word] += 1
        return encode(word)

    own.encode_word = counted
    text = " ".join(f"The {a}{b}q, the" for a in "abcdefghij" for b in "klmnopqrst")
    _same(own, library, text)
    assert calls[b"the"] == 1 and len(calls) == 102
    assert len(own.words) <= 10 and len(own.words.before) <= 10
    own.encode("x" * 65)
    assert "x" * 65 not in own.words


@pytest.mark.parametrize("signs", ["abeT 's.,9", "aé中 ²Ⅷ٣\x1c\x85'll", "abᲉ \x1cΣσ́ ̈'ve", "e<|endoftext|>  \n0"])
def test_pieces_and_letters_equal_the_library(automaton, library, monkeypatch, signs):
    monkeypatch.setattr(bpe, "PIECE", 7)
    own, rng = bpe.Tokenizer(automaton), random.Random(5)
    signs = [signs[i:i + k] for i in range(len(signs)) for k in (1, 2)] + (["<|endoftext|>"] if "<" in signs else [])
    for _ in range(300):
        _same(own, library, "".join(rng.choice(signs) for _ in range(rng.randint(0, 60))))


def test_paths_equal_merging_by_rank():
    """Few letters and many merges make the reader go back often."""
    rng, end, back = random.Random(6), bpe.WORD_END, 0
    for _ in range(60):
        tokens = [*"abc", *(x + end for x in "abc")]
        merges = []
        for _ in range(rng.randint(1, 25)):
            u, v = rng.choice([t for t in tokens if not t.endswith(end)]), rng.choice(tokens)
            if u + v not in tokens:
                merges.append((u, v))
                tokens.append(u + v)
        encode = bpe.Automaton({t: i for i, t in enumerate(tokens)}, merges, {}).encoder()
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
            parts = [*word[:-1], word[-1] + end]
            for u, v in merges:
                i = 0
                while i < len(parts) - 1:
                    if (parts[i], parts[i + 1]) == (u, v):
                        parts[i:i + 2] = [u + v]
                    i += 1
            got = [tokens[i] for i in encode(word.encode())]
            assert got == parts, (word, merges)
            longest = max((t for t in tokens if (word + end if t.endswith(end) else word).startswith(t)), key=len)
            back += parts[0] != longest
    assert back > 100
