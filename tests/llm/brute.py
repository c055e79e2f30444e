"""The contracts, computed plainly in Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
)
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def pii(text: str | None) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p, ok in PII for m in re.finditer(p, text or "") if ok(m)]


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    grams = [words[i : i + 3] for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components(prints: list[tuple[int | None, int]], distance: int = 2) -> dict[int, int | None]:
    """Smallest id of the component, by fingerprint."""
    nodes = sorted({f for _, f in prints})
    parent = {f: f for f in nodes}

    def root(f: int) -> int:
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    least: dict[int, int | None] = {}
    for d, f in prints:
        r = root(f)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return {f: least[root(f)] for f in nodes}


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), b"\n"]


def held(doc_id, n: int) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n == 0


def base_scores(rows: list[tuple]) -> list[tuple]:
    seen = Counter(t for d, x in rows if not held(d, 10) for t in tokens(x))
    total, distinct = sum(seen.values()), len(seen)
    return [
        (d, held(d, 10), len(tokens(x)), sum(seen[t] > 0 for t in tokens(x)), total,
         round(sum(math.log10((seen[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens(x)), 4))
        for d, x in rows
    ]


def without_repeats(rows: list[tuple], length: int = 200) -> list[tuple]:
    data = [(d, (x or "").encode()) for d, x in rows]
    seen = Counter(x[i : i + length] for _, x in data for i in range(len(x) - length + 1))
    out = []
    for d, x in data:
        gone, end = bytearray(len(x)), 0
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                start = max(i, end)
                gone[start : i + length] = b"\x01" * (i + length - start)
                end = i + length
        rest = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(x), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def contaminated(rows: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = lambda x: re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    grams: dict[tuple, set] = {}
    for i, x in items:
        w = lower(x)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[j : j + n]), set()).add(str(i))
    sizes = {len(g) for g in grams}
    out = []
    for d, x in rows:
        w = lower(x)
        hit, ids = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if found := grams.get(tuple(w[j : j + n])):
                    ids |= found
                    hit.update(range(j, j + n))
        out.append((d, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit) and 20 * len(hit) >= len(w)))
    return out
