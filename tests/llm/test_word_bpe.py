"""Word BPE against the tokenizers library: every code point, NUL, and texts that stand in one batch."""

import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tarnflow.llm import wordbpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return wordbpe.load(PATH), Tokenizer.from_file(PATH)


def same(both, texts):
    bpe, tok = both
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    got = [x.tolist() for x in bpe.encode(texts)]
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w][:3] == []
    for ids in want[:200]:
        assert bpe.decode(__import__("numpy").array(ids, dtype="<u4")).decode() == tok.decode(ids, skip_special_tokens=False)


def test_every_code_point_in_one_batch(both):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    # Planes without any character are all alike: some of each do.
    points = [c for c in points if ord(c) < 0x32000 or ord(c) % 997 == 0 or 0xE0000 <= ord(c) < 0xE0200]
    for start in range(0, len(points), 50_000):
        same(both, [f"a{c}1 {c}B" for c in points[start:start + 50_000]])


def test_a_text_changes_no_other(both):
    bpe, _ = both
    texts = ["a\0b", "a", "a\0zzz", "\0", "", "a\0", "zzz", "0", "None", "nan"]
    same(both, texts)
    for text in texts:
        assert bpe.encode([text])[0].tolist() == bpe.encode(texts)[texts.index(text)].tolist()


def test_mixtures(both):
    r = random.Random(4)
    known = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) not in ("Cs",)] + ["՘", "Ɤ", "\U00010940", "<|endoftext|>", "<|startoftext|>", "'s", " ", "\0"]
    same(both, ["".join(r.choice(known) for _ in range(r.randrange(30))) for _ in range(3000)])
