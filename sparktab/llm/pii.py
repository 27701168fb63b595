"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors (at-signs, plus signs, digits, schemes and
cues of identifiers); a deterministic parser for each kind expands an anchor to
both sides and validates what it finds.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from sparktab.llm.common import append

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "account", "ssn", "userinfo", "street")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"[:#\x20]*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?)(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:\x20?(?:no|nr|number|num)\b)?[.:#=\x20]{0,4}([0-9](?:[\x20-]?[0-9]){5,17})(?![0-9])", re.I)
SSN = re.compile(r"[.:#=\x20]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
USERINFO = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@(?=[A-Za-z0-9\[])")
# Cues of identifiers.
CUES = {
    "iban": ("IBAN", "iban", "Iban"),
    "account": ("account", "Account", "ACCOUNT", "acct", "Acct", "konto", "Konto", "cuenta", "Cuenta", "compte", "Compte"),
    "ssn": ("SSN", "ssn", "social security number", "Social Security Number", "Social security number"),
    "street": (" Street", " Avenue", " Road", " Boulevard", " Lane", " Drive"),
}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for a in ("@", "+", "://", *"0123456789"):
        out.add_word(a, ("digit" if a.isdigit() else a, len(a)))
    for kind, words in CUES.items():
        for w in words:
            out.add_word(w, (kind, len(w)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    value = value.replace(" ", "")
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _street(text: str, at: int) -> int | None:
    """The start of ``number Name [Name Name]`` that ends at a street cue."""
    start = at
    for _ in range(4):
        before = text.rfind(" ", max(0, start - 30), start)
        word = text[before + 1 : start]
        if word.isdigit() and word.isascii() and len(word) <= 5:
            return before + 1
        if before < 0 or not word[:1].isupper():
            return None
        start = before
    return None


def find_pii(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points by kind and start; of one kind they do not overlap."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "chain"), 0)

    def add(kind: str, start: int, end: int) -> None:
        if start >= done[kind]:
            found[kind].append((start, end))
            done[kind] = end

    for last, (kind, size) in automaton().iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= done["chain"]:
                m = CHAIN.match(text, at)
                done["chain"] = m.end()
                if m.end() - at > 6 and m[0].count(".") >= 3:
                    place, parts = at, m[0].split(".")
                    for i in range(0, len(parts) - 3, 4):
                        four = parts[i : i + 4]
                        end = place + sum(map(len, four)) + 3
                        if all(len(p.lstrip("0")) <= 3 and int(p[-4:] or 0) <= 255 for p in four):
                            found["ip"].append((place, end))
                        place = end + 1
            if at >= done["card"]:
                m = CARD.match(text, at)
                done["card"] = m.end()
                if m.end() - at >= 13:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append((at, m.end()))
        elif kind == "@":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                add("email", start, m.end())
        elif kind == "+":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                done["phone"] = m.end()
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    found["phone"].append((at, m.end()))
        elif kind == "://":
            if m := USERINFO.match(text, last + 1):
                add("userinfo", m.start(), m.end() - 1)
        elif kind == "iban":
            if (m := IBAN.match(text, last + 1)) and iban_valid(m[1]):
                add("iban", m.start(1), m.end(1))
        elif kind == "account":
            if m := ACCOUNT.match(text, last + 1):
                add("account", m.start(1), m.end(1))
        elif kind == "ssn":
            if m := SSN.match(text, last + 1):
                add("ssn", m.start(1), m.end(1))
        elif (start := _street(text, at)) is not None:
            add("street", start, last + 1)
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def pii_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The table with counts, digest and spans of the personal data in each whole text.

    Every row stays; null and empty texts have no spans. Other columns pass
    through; where one bears the name of a new one, the new one gets underscores.
    """

    def scan(text: bytes | None) -> tuple:
        spans = find_pii((text or b"").decode())
        said = [f"{k}:{s}:{e}" for k, s, e in spans]
        kinds = [k for k, _, _ in spans]
        base = ",".join(x for x, k in zip(said, kinds, strict=True) if k in BASE)
        return (*map(kinds.count, BASE), hashlib.sha256(base.encode()).hexdigest(), ",".join(said))

    fields = {"n_email": "long", "n_ip": "long", "n_card": "long", "n_phone": "long", "base_sha256": "string", "spans": "string"}
    return append(df, text_col, scan, fields)
