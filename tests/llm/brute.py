"""Plain Python versions of the operators, written without regard to size."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import numpy as np
import xxhash

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text: str | None) -> int:
    words = BLANKS.findall(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[tuple[int | None, int]], radius: int = 2) -> list[int | None]:
    """The smallest doc_id that each row reaches."""
    root = list(range(len(prints)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
            root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(prints))]


def spans_digest(spans: list[tuple[int, int, str, int]], base: int) -> tuple[str, str]:
    """(sha256 of the base spans, all spans) of (start, rank, kind, end)."""
    spans = sorted(spans, key=lambda x: (x[0], x[1], x[3]))
    text = lambda some: ",".join(f"{k}:{a}:{b}" for a, _, k, b in some)
    return hashlib.sha256(text([x for x in spans if x[1] < base]).encode()).hexdigest(), text(spans)


SECRET_KINDS = ("assign", "access", "hex")


def secrets(text: str | None, more=()) -> list[tuple[int, int, str, int]]:
    text, out = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out += [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    for i, (kind, pattern) in enumerate(more):
        out += [(m.start(), 3 + i, kind, m.end()) for m in re.finditer(pattern, text)]
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text: str | None) -> list[tuple[int, int, str, int]]:
    text, out = text or "", []
    out += [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return out


def nearest(ids: list[int], vectors: list[list[float]], every: int, k: int) -> dict[int, list[tuple[float, int]]]:
    """Each query's k nearest as (score, id), nearest first."""
    x = np.array(vectors, float)
    out = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            score = [float(np.dot(x[i], x[j])) for j in range(len(ids))]
            out[q] = sorted(((-s, ids[j]) for j, s in enumerate(score) if ids[j] != q))[:k]
    return {q: [(-s, v) for s, v in found] for q, found in out.items()}


def cut(ids: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces, the shorter one first."""
    first = len(ids) % capacity or min(capacity, len(ids))
    starts = [0, *range(first, len(ids), capacity)]
    ends = [*starts[1:], len(ids)]
    return [(a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for a, b in zip(starts, ends, strict=True)]


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def licenses(text: str | None, phrases: dict[str, str]) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels)."""
    words = LICENSE_WORD.findall(lower_ascii(text or ""))
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def edits_within(text: str, phrase: str, k: int) -> bool:
    """Whether some part of the text is within k edits of the phrase (Sellers' table)."""
    row = list(range(len(phrase) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(phrase, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != p)))
        row = new
        best = min(best, row[-1])
    return best <= k


def budgets(leaves: dict[tuple[str, str, str], int], weight, ratio: float, epochs: int) -> dict[tuple[str, str, str], float]:
    """Water-filling from the root down, by bisecting each level's rate."""
    out: dict[tuple[str, str, str], float] = {}

    def share(prefix: tuple[str, ...], budget: float) -> None:
        i = len(prefix)
        if i == 3:
            out[prefix] = budget
            return
        kids = sorted({k[i] for k in leaves if k[:i] == prefix})
        cap = {c: epochs * sum(n for k, n in leaves.items() if k[:i + 1] == (*prefix, c)) for c in kids}
        low, high = 0.0, 1e18
        for _ in range(300):
            mid = (low + high) / 2
            if sum(min(cap[c], mid * weight(i, c)) for c in kids) < budget:
                low = mid
            else:
                high = mid
        for c in kids:
            share((*prefix, c), min(cap[c], high * weight(i, c)))

    share((), ratio * sum(leaves.values()))
    return out
