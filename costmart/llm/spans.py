"""Finding of the fixed-format spans, in linear time on any text.

Each finder gives the leftmost non-overlapping matches of its pattern as
(start, end) in code points, without those that fail the further condition;
a failed match is not tried again from a later start.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

Span = tuple[int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
#: A start inside a run of digits can only fail where the run's start failed.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")


def emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", free if found else at + 1)


def ips(text: str) -> Iterator[Span]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        twice = 2 * int(d)
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                yield m.span()


def assigns(text: str) -> Iterator[Span]:
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= 6:
                yield m.span()


def accesses(text: str) -> Iterator[Span]:
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield m.span()


def hexes(text: str) -> Iterator[Span]:
    for m in HEX.finditer(text):
        yield m.span()


#: Kinds in their listed order.
PRIVATE = {"email": emails, "ip": ips, "card": cards, "phone": phones}
SECRET = {"assign": assigns, "access": accesses, "hex": hexes}


def find(text: str, kinds: dict) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end), sorted."""
    return sorted((a, k, b) for k, f in enumerate(kinds.values()) for a, b in f(text))


def written(spans: list[tuple[int, int, int]], names: list[str]) -> str:
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
