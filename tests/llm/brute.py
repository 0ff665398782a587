"""Plain Python versions of what the contracts fix, for small tables."""

import hashlib
import re

import xxhash

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    at, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i:i + len(parts)] == parts:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def private_base(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    kinds = ("email", "ip", "card", "phone")
    out.sort()
    joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in out)
    return [sum(k == i for _, k, _ in out) for i in range(4)], hashlib.sha256(joined.encode()).hexdigest(), joined


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(values, links):
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in values}
