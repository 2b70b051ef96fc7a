"""Document statistics of the quality classifier against plain loops."""

from __future__ import annotations

import math

import pytest

from gristmill.llm import quality

TEXTS = [
    "", "  \n ", "One", "a b a b a\nb | | 12 12345678 word9999", "The END. The END? x!! y$$$ ÀÉ été 数字 12\n\nThe END. The END?\n  \nlast line", "|" * 50, "1234567890123 " * 40, "Wort wort\tWORT\nwort wort - - (a); b: 'c' &&&",
]


def plain(text):
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    if not words:
        return {n: 0.0 for n in quality.STATISTICS} | {"log_chars": math.log(1 + len(text))}
    kinds, pairs = sorted(set(words)), list(zip(words, words[1:]))
    ends, inside = 0, False
    for c in text:
        ends += c in ".?!" and not inside
        inside = c in ".?!"
    n, m, p, letters = len(text), len(words), max(len(words) - 1, 1), sum(len(w) for w in words)
    return {
        "log_chars": math.log(1 + n), "log_words": math.log(1 + m), "mean_word": letters / m, "longest_word": max(len(w) for w in words), "upper": sum(w.isupper() for w in kinds) / len(kinds),
        "digits": sum(c.isdecimal() for c in text) / n, "spaces": (n - letters) / n, "marks": sum(c in "&%$#*|!@^~<>{}[]\\=+_" for c in text) / n, "points": sum(c in ".,;:?()\"'-" for c in text) / n,
        "lines": len(lines) / m, "line_length": n / max(len(lines), 1), "repeated_lines": 1 - len(set(lines)) / max(len(lines), 1), "top_line": max(lines.count(x) for x in lines) / len(lines), "distinct_words": len(kinds) / m,
        "top_word": max(words.count(w) for w in kinds) / m, "doubled_words": sum(a == b for a, b in set(pairs)) / max(len(set(pairs)), 1), "distinct_pairs": len(set(pairs)) / p,
        "top_pair": max((pairs.count(x) for x in pairs), default=0) / p, "sentence_words": m / (ends + 1), "capital_words": sum(w[0].isupper() for w in kinds) / len(kinds),
        "letterless_words": words.count("|") / m + sum(not w.isalpha() and w.lower() == w.upper() for w in kinds) / len(kinds), "one_letter_words": sum(len(w) == 1 for w in kinds) / len(kinds),
        "other_script": sum(ord(c) > 127 for c in text) / n if text.lower() != text.upper() else 0.0,
    }


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_equal_plain_loops(text):
    got, want = dict(zip(quality.STATISTICS, quality.statistics(text))), plain(text)
    for name, value in want.items():
        assert got[name] == pytest.approx(value), name


def test_digits_are_seen_wherever_they_stand():
    place = quality.STATISTICS.index("digits")
    assert quality.statistics("word9999")[place] == quality.statistics("9999word")[place] == 0.5
