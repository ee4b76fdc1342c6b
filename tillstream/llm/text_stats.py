"""Statistics of a document's text, one row of numbers each; inputs of the quality models."""

from __future__ import annotations

import re

import numpy as np

_SYMBOL = re.compile(rb"[#*$%&|<>]+")
_PUNCTUATION = re.compile(rb"[!?]+")
_UPPER = re.compile(rb"[A-Z]+")
_DIGIT = re.compile(rb"[0-9]+")

#: Counts as the rules name them.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Inputs of the models: logs of sizes, the rest are shares.
FEATURES = (
    "log_words", "mean_word", "symbols_per_char", "marks_per_char", "upper_per_char", "digits_per_char",
    "dup_line_share", "repeat_word_share", "distinct_share", "top_word_share", "echo_share", "lines_per_word",
    "symbol_ended_share",
)



def _total(pattern: re.Pattern, text: bytes) -> int:
    return sum(map(len, pattern.findall(text)))


def repeated_words(numbers: np.ndarray) -> int:
    """Words that lie in a 3-word window found at least twice, the first finding included."""
    n = len(numbers)
    if n < 4:
        return 0
    top = np.int64(numbers.max()) + 1
    pairs = numbers[:-1] * top + numbers[1:]
    if top < 2_000_000:
        windows = pairs[:-1] * top + numbers[2:]
    else:
        windows = np.unique(pairs, return_inverse=True)[1][:-1] * top + numbers[2:]
    _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
    hit = count[where] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : shift + n - 2] |= hit
    return int(inside.sum())


def describe(text: bytes | None) -> tuple[list[int], list[float]]:
    """(counts in the order of COUNTS, features in the order of FEATURES); no text counts as empty."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0] * len(COUNTS), [0.0] * len(FEATURES)
    numbers = np.fromiter(map({w: i for i, w in enumerate(dict.fromkeys(words))}.__getitem__, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip()]
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = _total(_SYMBOL, joined)
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(numbers)
    times = np.bincount(numbers)
    counts = [n, chars, symbols, dup_lines, repeats]
    features = [
        float(np.log1p(n)),
        chars / n,
        symbols / chars,
        _total(_PUNCTUATION, joined) / chars,
        _total(_UPPER, joined) / chars,
        _total(_DIGIT, joined) / chars,
        dup_lines / len(lines),
        repeats / n,
        len(times) / n,
        float(times.max()) / n,
        float((numbers[1:] == numbers[:-1]).mean()) if n > 1 else 0.0,
        len(lines) / n,
        sum(w[-1] in b"#*$%&|<>!" for w in words) / n,
    ]
    return counts, features


def describe_all(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    rows = [describe(text) for text in texts]
    counts = np.array([row[0] for row in rows], np.int64).reshape(-1, len(COUNTS))
    return counts, np.array([row[1] for row in rows], float).reshape(-1, len(FEATURES))
