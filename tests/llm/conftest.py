import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2])]

SAMPLES = [
    None, "", " ", "\n", "a", "Hello world", "don't  stop\n\n now", "  lead", "trail  ",
    "<|endoftext|>", "x<|endoftext|>y <|startoftext|> z", "<|ENDOFTEXT|>", "ÀÉ élan naïve ΑΣ Σ",
    "日本語 テキスト 123 ４５", "\x1c\x1f a\x85b\xa0c d　", "'s 't 'll I'll we've",
    "é ́x Å ẛ̣", "🙂🙂 👩‍👩‍👧 ‍", "a" * 3000, "ab" * 2000, "é" * 999,
    "tab\tand\x0bvt\x0cff\rcr", "!!! ... ,,, a,b.c;d", "x²½Ⅷ ٣", "İstanbul ſ ß ẞ", "﻿bom \u0000nul",
    "word., word,. word.. WORD, Ωμέγα.", "1234567 8 9.5", "_under_ score_", "\r\n\r\n \t\n x",
]


@pytest.fixture(scope="session")
def samples():
    return SAMPLES
