"""String similarity on a 0-100 scale: token handling in native columns, one Arrow UDF for common subsequences.

The base measure is the normalised Indel similarity: twice the longest common subsequence over the summed
lengths. The subsequence length comes from the bit-parallel recurrence of Hyyro (2004), run for many pairs of
an Arrow batch at once, with as many 64-bit words a pair as its shorter string needs.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = 64


def _codes(texts: list[str], width: int, pad: int) -> np.ndarray:
    joined = "".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, dtype=np.uint32).reshape(len(texts), width).copy()
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    codes[np.arange(width) >= lengths[:, None]] = pad
    return codes


def _lcs_words(short: list[str], long: list[str], words: int) -> np.ndarray:
    """Common subsequence lengths of pairs whose first strings have at most ``words`` * 64 characters."""
    a = _codes(short, words * _WORD, 0xFFFFFFFF)
    b = _codes(long, max(1, max(map(len, long))), 0xFFFFFFFE)
    rest = np.full((len(short), words), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for j in range(b.shape[1]):
        match = np.packbits(a == b[:, j : j + 1], axis=1, bitorder="little").view("<u8")
        hit = rest & match
        kept = rest - hit
        carry = np.zeros(len(short), dtype=np.uint64)
        for w in range(words):
            total = rest[:, w] + hit[:, w]
            over = total < hit[:, w]
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            rest[:, w] = total | kept[:, w]
    return words * _WORD - np.bitwise_count(rest).astype(np.int64).sum(axis=1)


def char_masks(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def lcs_with_masks(masks: dict[str, int], length: int, other: str) -> int:
    """Longest common subsequence of a text given by its masks and ``other``; any lengths."""
    full = (1 << length) - 1
    rest = full
    for ch in other:
        hit = rest & masks.get(ch, 0)
        rest = ((rest + hit) | (rest - hit)) & full
    return length - rest.bit_count()


def lcs_lengths(left: list[str], right: list[str], cells: int = 8192 * _WORD) -> np.ndarray:
    """Longest common subsequence of each pair; pairs of like size are worked on together, about ``cells`` characters at a time."""
    swap = [len(a) > len(b) for a, b in zip(left, right, strict=True)]
    short = [b if s else a for a, b, s in zip(left, right, swap, strict=True)]
    long = [a if s else b for a, b, s in zip(left, right, swap, strict=True)]
    out = np.zeros(len(left), dtype=np.int64)
    words = np.array([max(1, -(-len(a) // _WORD)) for a in short], dtype=np.int64)
    order = np.lexsort((np.fromiter(map(len, long), np.int64, len(long)), words))
    at = 0
    while at < len(order):
        size = int(words[order[at]])
        end = min(int(np.searchsorted(words[order], size, side="right")), at + max(1, cells // (size * _WORD)))
        part = order[at:end]
        out[part] = _lcs_words([short[i] for i in part], [long[i] for i in part], size)
        at = end
    return out


def _shared_ends(texts: list[str]) -> tuple[int, int]:
    """Lengths of the prefix and the suffix that all texts share, without overlap."""
    head = len(os.path.commonprefix([min(texts), max(texts)]))
    tails = [t[head:][::-1] for t in texts]
    return head, len(os.path.commonprefix([min(tails), max(tails)]))


def lcs_table(left: list[str], right: list[str]) -> np.ndarray:
    """Longest common subsequence of every left text with every right one; each side's texts are of one length.

    What all texts begin and end with is common to every pair and set aside. The rest of a left text becomes a bit mask per
    character, and all right texts step through the recurrence together.
    """
    head, tail = _shared_ends(left + right)
    rests = [[t[head : len(t) - tail] for t in side] for side in (left, right)]
    m, n = len(rests[0][0]), len(rests[1][0])
    if m > n:
        return lcs_table(right, left).T
    if m > _WORD:
        return head + tail + np.array([lcs_lengths([t] * len(right), rests[1]) for t in rests[0]])
    letters, codes = np.unique(np.frombuffer("".join(rests[0] + rests[1]).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    a = codes[: m * len(left)].reshape(len(left), m)
    b = np.ascontiguousarray(codes[m * len(left) :].reshape(len(right), n).T)
    bits = np.uint64(1) << np.arange(m, dtype=np.uint64)
    out = np.empty((len(left), len(right)), dtype=np.int32)
    hit, total = np.empty(len(right), np.uint64), np.empty(len(right), np.uint64)
    for i in range(len(left)):
        masks = np.zeros(max(1, len(letters)), np.uint64)
        np.bitwise_or.at(masks, a[i], bits)
        rest = np.full(len(right), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        for column in b:
            np.take(masks, column, out=hit, mode="clip")
            np.bitwise_and(rest, hit, out=hit)
            np.add(rest, hit, out=total)
            np.subtract(rest, hit, out=rest)
            np.bitwise_or(rest, total, out=rest)
        out[i] = _WORD - np.bitwise_count(rest)
    return out + (head + tail)


def score_of(total: np.ndarray, common: np.ndarray) -> np.ndarray:
    """``ratio`` from the summed length and the common subsequence."""
    return np.where(total > 0, (1.0 - (total - 2 * common) / np.maximum(total, 1)) * 100.0, 100.0)


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    total = np.fromiter((len(a) + len(b) for a, b in zip(left, right)), np.int64, len(left))
    return score_of(total, lcs_lengths(left, right))


def token_set_score(tokens_a: set[str], tokens_b: set[str]) -> float:
    """Best of three comparisons around the shared tokens; see ``token_set_ratio``."""
    if not tokens_a or not tokens_b:
        return 0.0
    shared = tokens_a & tokens_b
    only_a, only_b = " ".join(sorted(tokens_a - shared)), " ".join(sorted(tokens_b - shared))
    if shared and (not only_a or not only_b):
        return 100.0
    masks = char_masks(only_a)
    common = lcs_with_masks(masks, len(only_a), only_b)
    return set_score(sum(map(len, shared)) + max(len(shared) - 1, 0), len(only_a), len(only_b), common)


def set_score(shared: int, only_a: int, only_b: int, common: int) -> float:
    """Score from the lengths of the shared text and of both rests, and the rests' common subsequence."""
    gap = 1 if shared else 0
    total = 2 * (shared + gap) + only_a + only_b
    best = 100.0 - 100.0 * (only_a + only_b - 2 * common) / total if total else 100.0
    if shared:
        for rest in (only_a, only_b):
            best = max(best, 100.0 - 100.0 * (gap + rest) / (2 * shared + gap + rest))
    return best


@F.pandas_udf(T.DoubleType())
def _ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        both = (a.notna() & b.notna()).to_numpy()
        scores = np.full(len(a), np.nan)
        if both.any():
            scores[both] = ratios(a[both].tolist(), b[both].tolist())
        yield pd.Series(scores).astype("object").where(both, None)


@F.pandas_udf(T.LongType())
def _common(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        both = (a.notna() & b.notna()).to_numpy()
        lengths = np.zeros(len(a), dtype=np.int64)
        if both.any():
            lengths[both] = lcs_lengths(a[both].tolist(), b[both].tolist())
        yield pd.Series(lengths).astype("object").where(both, None)


def tokens(text: Column) -> Column:
    """White-space separated tokens; no empty ones."""
    return F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda t: F.length(t) > 0)


def sorted_form(text: Column) -> Column:
    """Tokens in order, joined by one space."""
    return F.array_join(F.array_sort(tokens(text)), " ")


def ratio(a: Column, b: Column) -> Column:
    """100 * 2 * LCS / (len a + len b); two empty texts give 100."""
    return _ratio(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """``ratio`` of the token-sorted texts: word order does not matter."""
    return _ratio(sorted_form(a), sorted_form(b))


def token_set_ratio(a: Column, b: Column) -> Column:
    """Similarity around the common token set S of A and B.

    100 if S is not empty and one side has no other tokens; else the best of S+A' against S+B', S against
    S+A' and S against S+B'. An empty side gives 0. Sets and lengths are array functions; only the common subsequence of A' and B'
    leaves the JVM.
    """
    left, right = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    rest_a = F.array_join(F.array_sort(F.array_except(left, right)), " ")
    rest_b = F.array_join(F.array_sort(F.array_except(right, left)), " ")
    s = F.length(F.array_join(F.array_intersect(left, right), " "))
    m, n, common = F.length(rest_a), F.length(rest_b), _common(rest_a, rest_b)
    gap = F.when(s > 0, 1).otherwise(0)
    whole = 100.0 - 100.0 * (m + n - 2 * common) / F.greatest(2 * (s + gap) + m + n, F.lit(1))
    part = lambda rest: F.when(s > 0, 100.0 - 100.0 * (gap + rest) / (2 * s + gap + rest))
    score = F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0).when((s > 0) & ((m == 0) | (n == 0)), 100.0)
    return F.when(a.isNotNull() & b.isNotNull(), score.otherwise(F.greatest(whole, part(m), part(n))))


def best_choice(scored, query: str, choice: str, score: str, ordinal: str, cutoff: float = 0.0):
    """Of scored pairs, the best choice per query at or above the cutoff; ties go to the lowest ordinal."""
    best = F.max_by(F.struct(F.col(choice), F.col(score)), F.struct(F.col(score), -F.col(ordinal))).alias("_best")
    return scored.filter(F.col(score) >= cutoff).groupBy(query).agg(best).select(query, f"_best.{choice}", f"_best.{score}")


def choices_above(scored, score: str, cutoff: float):
    """All scored pairs at or above the cutoff."""
    return scored.filter(F.col(score) >= cutoff)
