import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from weir.llm import tokens

ODD = [
    "it's we'll I'VE rock'n'roll don't.", "İstanbul ß STRASSE ǅ ﬁ é É́", "a\x1cb\x85c\xa0d e f", "x<|endoftext|>y <|startoftext|>", "12²³ ½ª º µ × ÷ ÿ",
    "\U0001f600abc 日本語テキスト한국어", "''s 's' ''", "foo__bar--baz!!!", "", " \n\t ", "Σίσυφος ΣΑΣ", "a" * 300, "A'S 'S 'Re", "x'sy we'red 'dd 'llama", "\x00\x01 \x7f",
]


def same(encoder, library, texts):
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder(text.encode()) == np.array(wanted.ids, "<u4").tobytes(), repr(text)


def test_words_equal_whole_texts():
    encoder = tokens.Encoder(tokens.default_tokenizer())
    assert encoder.words is not None
    rng = random.Random(1)
    alphabet = "aAbB'sStTéÉ1²!?.<|>́  \x1c\n日ßİ"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(5000)]
    same(encoder, Tokenizer.from_file(tokens.default_tokenizer()), texts)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 3)
    same(tokens.Encoder(tokens.default_tokenizer()), Tokenizer.from_file(tokens.default_tokenizer()), ODD * 3)


def test_other_tokenizers_encode_whole_texts():
    path = tokens.default_tokenizer().replace("word_bpe_49k", "byte_bpe_50k")
    encoder = tokens.Encoder(path)
    assert encoder.words is None
    same(encoder, Tokenizer.from_file(path), ODD)


def test_encoders_are_kept():
    assert tokens.encoder(tokens.default_tokenizer()) is tokens.encoder(tokens.default_tokenizer())
    with pytest.raises(OSError):
        tokens.encoder("/no/such/file")
