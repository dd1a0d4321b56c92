"""Plain-Python string helpers of the subpackage."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

# Letters that decomposition doesn't reduce, and signs that scans and keyboards confuse with letters.
LETTERS = str.maketrans({"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ı": "i", "ɑ": "a", "’": "'", "‘": "'", "ʼ": "'", "´": "'", "`": "'", "­": "", "​": "", "‐": "-", "‑": "-", "–": "-", "—": "-"})


@lru_cache(maxsize=1 << 16)
def unaccent(s: str) -> str:
    """Without accents and soft hyphens, in compatibility form."""
    s = unicodedata.normalize("NFKD", s.translate(LETTERS))
    return unicodedata.normalize("NFC", "".join(c for c in s if not unicodedata.combining(c)))


def within(a: str, b: str, k: int) -> int | None:
    """Edit distance of a and b (insertion, deletion, substitution, exchange of neighbours) if it is k at most, else None; only a band of 2k + 1 diagonals is filled."""
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return None
    if a == b:
        return 0
    far = k + 1
    before: list[int] = []
    last = [j if j <= k else far for j in range(m + 1)]
    for i in range(1, n + 1):
        lo, hi = max(1, i - k), min(m, i + k)
        row = [far] * (m + 1)
        if i <= k:
            row[0] = i
        for j in range(lo, hi + 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d = min(d, before[j - 2] + 1)
            row[j] = d
        if min(row[max(0, i - k) : hi + 1]) > k:
            return None
        before, last = last, row
    return last[m] if last[m] <= k else None
