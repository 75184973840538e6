"""Plain Python versions that the operators are held against on small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def base_pii(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for kind, pattern, good in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if good(m[0])]
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
