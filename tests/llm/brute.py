"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ["email", "ip", "card", "phone", "term"]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    plain = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    }
    found = [(m.start(), i, m.end()) for i, (p, ok) in enumerate(plain.values()) for m in re.finditer(p, text or "") if ok(m)]
    return sorted(found)


def terms(text):
    return [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{4,}", text)]


def pii(rows):
    """doc_id -> (counts, base spans, all spans)."""
    contexts = defaultdict(set)
    mentions = defaultdict(set)
    texts = defaultdict(set)
    for _, text in rows:
        text = text or ""
        for t, _, _ in terms(text):
            texts[t].add(text)
        for s, k, e in base_spans(text):
            left = [t for t, _, _ in terms(text[max(0, s - 200) : s])]
            right = [t for t, _, _ in terms(text[e : e + 200])]
            left = (left[1:] if s > 200 else left)[-8:]
            right = (right[:-1] if len(text) - e > 200 else right)[:8]
            value = text[s:e]
            value = (k, value.lower() if k == 0 else value if k == 1 else re.sub("[^0-9]", "", value))
            for t in {*left, *right}:
                mentions[value].add(text)
                contexts[t, value].add(text)
    flagged = set()
    for (t, value), seen in contexts.items():
        if len(seen) >= 3:
            posterior = min(1.0, len(seen) / len(texts[t]))
            if posterior >= 0.5 and math.log2(posterior * len(rows) / len(mentions[value])) >= 6:
                flagged.add(t)
    out = []
    for i, text in rows:
        base = base_spans(text)
        more = [(s, 4, e) for t, s, e in terms(text or "") if t in flagged]
        count = Counter(k for _, k, _ in base)
        listed = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
        out.append((i, *[count[k] for k in range(4)], len(more), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more)))
    return out
