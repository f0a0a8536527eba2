"""String distances in plain Python, shared by the Arrow-batched functions."""

from __future__ import annotations


def osa(a: str, b: str, limit: int) -> int:
    """Edit distance with adjacent transpositions (each character edited once), or ``limit + 1`` beyond it."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    # Common ends need no edits.
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return max(len(a), len(b))
    if limit == 1:
        one = len(a) == len(b) and (len(a) == 1 or (len(a) == 2 and a[0] == b[1] and a[1] == b[0]))
        return 1 if one else 2
    before, row = None, list(range(len(b) + 1))
    for x in range(1, len(a) + 1):
        new = [x] + [0] * len(b)
        for y in range(1, len(b) + 1):
            new[y] = min(row[y] + 1, new[y - 1] + 1, row[y - 1] + (a[x - 1] != b[y - 1]))
            if x > 1 and y > 1 and a[x - 1] == b[y - 2] and a[x - 2] == b[y - 1]:
                new[y] = min(new[y], before[y - 2] + 1)
        if min(new) > limit:
            return limit + 1
        before, row = row, new
    return min(row[-1], limit + 1)


def lcs_ratio(a: str, b: str) -> float:
    """``2 * LCS / (|a| + |b|)``, the normalised indel similarity; 1.0 for two empty strings."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    # Bit-parallel longest common subsequence (Hyyro 2004).
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    v = (1 << len(a)) - 1
    full = v
    for c in b:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & full
    lcs = len(a) - bin(v).count("1")
    return 2.0 * lcs / (len(a) + len(b))


def token_sort_ratio(a: str, b: str) -> float:
    """Indel similarity of the blank-separated tokens in sorted order."""
    return lcs_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    """Jaro similarity with a bonus for a common prefix of up to four characters."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    hit_b = [False] * len(b)
    in_a = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not hit_b[j] and b[j] == c:
                hit_b[j] = True
                in_a.append(c)
                break
    m = len(in_a)
    if not m:
        return 0.0
    in_b = [c for c, h in zip(b, hit_b) if h]
    swaps = sum(x != y for x, y in zip(in_a, in_b)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * scale * (1 - jaro)
