"""Format-preserving pseudonyms for personal data.

A value that passes its format's checks (Luhn, mod 97, calendar, number ranges) is a
number below the size of its domain. A keyed Feistel network permutes that domain, and
the result is written back in the layout of the original, with check digits made anew.
Equal values get equal pseudonyms in every document, different values different ones,
and the key's holder can go back.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import need

ROUNDS = 8
GAP = "\x00"

#: Length of an IBAN by country.
IBAN_LENGTHS = {
    c: n for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items() for c in countries.split()
}


class Cipher:
    """Keyed permutations of the numbers below any n, one for each name."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = hashlib.blake2b(key, digest_size=32).digest(), back

    def _mix(self, name: bytes, turn: int, half: int, mask: int) -> int:
        data = name + bytes([turn]) + half.to_bytes((half.bit_length() + 7) // 8 + 1, "big")
        out, wide = b"", (mask.bit_length() + 7) // 8
        while len(out) < wide:
            out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=self.key, digest_size=64).digest()
        return int.from_bytes(out[:wide], "big") & mask

    def permute(self, x: int, n: int, name: str, ok: Callable[[int], bool] | None = None) -> int:
        """The number that ``x`` goes to, among those below ``n`` for which ``ok`` holds."""
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask, tag = (1 << bits) - 1, f"{name}/{n}/".encode()
        turns = range(ROUNDS - 1, -1, -1) if self.back else range(ROUNDS)
        while True:
            left, right = x >> bits, x & mask
            for t in turns:
                if self.back:
                    left, right = right ^ self._mix(tag, t, left, mask), left
                else:
                    left, right = right, left ^ self._mix(tag, t, right, mask)
            x = left << bits | right
            # Walk the cycle until the number is in the domain again.
            if x < n and (ok is None or ok(x)):
                return x


def luhn(digits: str) -> int:
    """Check digit that belongs after ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (2 if k % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return -total % 10


def _refill(layout: str, chars: str) -> str:
    """``layout`` with its ASCII letters and digits replaced in turn, in the case they had."""
    it = iter(chars)
    out = []
    for c in layout:
        if c.isascii() and c.isalnum():
            x = next(it)
            c = x.upper() if c.isupper() else x
        out.append(c)
    return "".join(out)


def _plain(text: str) -> str:
    return "".join(c for c in text if c.isascii() and c.isalnum())


def _spelled(cipher: Cipher, text: str, name: str, hexadecimal: bool = False) -> str:
    """Letters and digits of ``text`` permuted together, each place within its kind."""
    chars = _plain(text).lower()
    if hexadecimal:
        sets = ["0123456789abcdef"] * len(chars)
    else:
        sets = ["0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" for c in chars]
    x = n = 0
    n = 1
    for c, s in zip(chars, sets):
        x, n = x * len(s) + s.index(c), n * len(s)
    if n == 1:
        return text
    shape = "".join("d" if s[-1] == "9" else "x" if hexadecimal else "a" for s in sets)
    x = cipher.permute(x, n, f"{name}/{shape}")
    out = []
    for s in reversed(sets):
        x, r = divmod(x, len(s))
        out.append(s[r])
    new = "".join(reversed(out))
    if hexadecimal:  # a digit may become a letter, so the case is that of the whole
        return new.upper() if text == text.upper() else new
    return _refill(text, new)


class Part:
    """Part of a text in place of a match."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.ends = text[start:end], (start, end)

    def __getitem__(self, _) -> str:
        return self.text

    def start(self) -> int:
        return self.ends[0]

    def end(self) -> int:
        return self.ends[1]


def _card_ok(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn(digits[:-1]) == int(digits[-1]) and len(set(digits)) > 1


def cards(text: str, runs: re.Pattern) -> Iterator[Part]:
    """Card numbers in runs of digit groups, none overlapping.

    The whole run is tried first, whatever its layout. Then come the parts that start at a
    group, from left to right and from the longest to the shortest, of one separator and
    with four digits or more in all groups but the last.
    """
    for run in runs.finditer(text):
        groups = [g.span() for g in re.finditer("[0-9]+", run[0])]
        if sum(b - a for a, b in groups) < 13:
            continue
        base, k = run.start(), 0
        if _card_ok(_plain(run[0])):
            yield Part(text, base, run.end())
            continue
        while k < len(groups):
            ends, n = [], 0
            for j in range(k, len(groups)):
                a, b = groups[j]
                n += b - a
                if n > 19 or (j > k + 1 and run[0][a - 1] != run[0][groups[k + 1][0] - 1]):
                    break
                if n >= 13:
                    ends.append(j)
                if b - a < 4:
                    break
            start = groups[k][0]
            last = next((j for j in reversed(ends) if _card_ok(_plain(run[0][start : groups[j][1]]))), None)
            if last is not None:
                yield Part(text, base + start, base + groups[last][1])
            k = k + 1 if last is None else last + 1


def card(cipher: Cipher, m: Part) -> str | None:
    """The pseudonym keeps the other Luhn sum too.

    So a card followed by an odd number of digits, as by its CVV, passes or fails
    together with them as before, and going back finds the same card.
    """
    digits = _plain(m[0])
    if not _card_ok(digits):
        return None
    size, other = len(digits) - 1, luhn(digits)

    def usable(x: int) -> bool:
        d = f"{x:0{size}d}"
        d += str(luhn(d))
        return len(set(d)) > 1 and luhn(d) == other

    body = f"{cipher.permute(int(digits[:-1]), 10**size, 'card', usable):0{size}d}"
    return _refill(m[0], body + str(luhn(body)))


def phone(cipher: Cipher, m: re.Match) -> str | None:
    """The country code stays."""
    head, rest = m["code"] or "", m["rest"]
    digits = _plain(rest)
    if not 7 <= len(digits) + len(_plain(head)) <= 15 or len(digits) < 6:
        return None
    body = cipher.permute(int(digits), 10 ** len(digits), f"phone/{_plain(head)}")
    return head + _refill(rest, f"{body:0{len(digits)}d}")


def _rest(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def _iban_ok(chars: str) -> bool:
    return 15 <= len(chars) <= 34 and _rest(chars[4:] + chars[:4]) == 1


def ibans(text: str, starts: re.Pattern) -> Iterator[Part]:
    """IBANs, none overlapping: from each start that of the country's length, else the longest that ends with a group."""
    done = 0
    for m in starts.finditer(text):
        if m.start() < done:
            continue
        ends, n, last = {}, 0, 0
        for c in re.finditer("[ -]?[A-Z0-9]", text[m.start() : m.start() + 68]):
            if c.start() != last or n == 34:
                break
            n, last = n + 1, c.end()
            if n >= 15 and not re.match("[A-Za-z0-9]", text[m.start() + last : m.start() + last + 1]):
                ends[n] = m.start() + last
        usual = IBAN_LENGTHS.get(m[0][:2])
        for n in sorted(ends, key=lambda n: (n != usual, -n)):
            if _iban_ok(_plain(text[m.start() : ends[n]])):
                done = ends[n]
                yield Part(text, m.start(), done)
                break


def iban(cipher: Cipher, m: Part) -> str | None:
    chars = _plain(m[0])
    if not _iban_ok(chars):
        return None
    body = _spelled(cipher, chars[4:], "iban/" + chars[:2])
    return _refill(m[0], chars[:2] + f"{98 - _rest(body + chars[:2] + '00'):02d}" + body)


def _social_ok(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def social(cipher: Cipher, m: re.Match) -> str | None:
    x = int(_plain(m[0]))
    return _refill(m[0], f"{cipher.permute(x, 10**9, 'social', _social_ok):09d}") if _social_ok(x) else None


def address(cipher: Cipher, m: re.Match) -> str | None:
    parts = m[0].split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = cipher.permute(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, "address")
    return ".".join(map(str, x.to_bytes(4, "big")))


_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def date(cipher: Cipher, m: re.Match) -> str | None:
    """Day and month may stand in either order if both are possible; then day comes first.

    A day or month of one digit goes to one of one digit, so the layout tells the way back.
    """
    year_first = m["y1"] is not None
    a, b = (int(m["a1"]), int(m["b1"])) if year_first else (int(m["a2"]), int(m["b2"]))
    year = int(m["y1"] or m["y2"])
    sep = m["s1"] if year_first else m["s2"]
    widths = len(m["a1"] or m["a2"]), len(m["b1"] or m["b2"])
    for day_first in (False,) if year_first else (True, False):
        month, day = (b, a) if day_first else (a, b)
        try:
            x = datetime.date(year, month, day).toordinal() - _FIRST
        except ValueError:
            continue
        if not 0 <= x <= _LAST - _FIRST:
            return None

        def same_reading(n: int, day_first=day_first) -> bool:
            # A month-first date must not read as day-first afterwards.
            d = datetime.date.fromordinal(n + _FIRST)
            two = (d.day, d.month) if day_first else (d.month, d.day)
            return (year_first or day_first or d.day > 12) and all(w == 2 or x < 10 for w, x in zip(widths, two))

        def layout(n: int) -> str:
            d = datetime.date.fromordinal(n + _FIRST)
            two = (d.day, d.month) if day_first else (d.month, d.day)
            two = [f"{x:0{w}d}" for w, x in zip(widths, two)]
            return f"{d.year}{sep}{two[0]}{sep}{two[1]}" if year_first else f"{two[0]}{sep}{two[1]}{sep}{d.year}"

        reading = "m" if not (year_first or day_first) else "d"
        return layout(cipher.permute(x, _LAST - _FIRST + 1, "date" + reading, same_reading))
    return None


def email(cipher: Cipher, m: re.Match) -> str | None:
    """The domain stays; the part before it changes letter by letter, digit by digit."""
    local, _, domain = m[0].rpartition("@")
    shown = _spelled(cipher, local, "email/" + domain.lower())
    return None if shown == local else f"{shown}@{domain}"


def secret(cipher: Cipher, m: re.Match) -> str | None:
    group = "value" if m["value"] else "bare"
    value = m[group]
    hexadecimal = re.fullmatch("[0-9a-f]{16,}|[0-9A-F]{16,}", value) is not None
    at = m.start(group) - m.start()
    return m[0][:at] + _spelled(cipher, value, "secret", hexadecimal) + m[0][at + len(value) :]


#: In order: an earlier kind keeps its place against a later one.
KINDS: tuple[tuple[str, str, re.Pattern, Callable], ...] = (
    ("secret", "=:", re.compile(
        r"(?i)(?<![A-Za-z0-9])(?:api[_-]?key|access[_-]?key|auth[_-]?key|secret|token|password|passwd|pwd)[\"']?\s{0,3}[=:]"
        r"(?:\s{0,3}(?P<q>[\"'])(?P<value>[A-Za-z0-9_+/=.-]{8,200})(?P=q)"
        # Without quotes up to white space; no comparison, call, subscript or placeholder, and no plain word after a colon.
        r"|(?!=)(?<![=!<>]=)(?:(?<==)|(?![ \t]{0,3}[A-Za-z-]+[.,;:!?)]*(?:\s|\Z)))"
        r"[ \t]{0,3}(?![A-Za-z_][\w.]*[(\[]|\$?[{<(])(?P<bare>(?:(?![,;&][\w.-]+[\"']?[=:])[^\s\"'\x00]){8,4096}))"), secret),
    ("email", "@", re.compile(
        r"(?<![\w.%+-])[\w%+-](?:[\w.%+-]{0,62}[\w%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![\w-])"), email),
    ("iban", "0123456789", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ -]?[A-Z0-9])"), iban),
    ("date", "0123456789", re.compile(
        r"(?<![\w.])(?:(?P<y1>(?:19|20)\d\d)(?P<s1>[-/.])(?P<a1>\d\d?)(?P=s1)(?P<b1>\d\d?)(?=[Tt]\d\d(?!\d)|[Tt]\d{4}|(?![\w]|[-/.]\d))"
        r"|(?P<a2>\d\d?)(?P<s2>[-/.])(?P<b2>\d\d?)(?P=s2)(?P<y2>(?:19|20)\d\d)(?![\w]|[-/.]\d))"), date),
    ("social", "0123456789", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)"), social),
    ("card", "0123456789", re.compile(r"(?<![A-Za-z0-9.-])[0-9]+(?:[ -][0-9]+)*(?![A-Za-z0-9]|\.\d)"), card),
    ("address", ".", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"), address),
    ("phone", "0123456789", re.compile(
        r"(?<![A-Za-z0-9])(?:(?P<code>\+1[ .-]?)?(?P<rest>(?:\(\d{3}\) ?|(?<!\w)\d{3}[ .-]|(?<=1)\d{3}[ .-]?)\d{3}[ .-]?\d{4})"
        r"|(?P<code2>\+[2-9]\d{0,2}[ .-]?)(?P<rest2>(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}))(?![A-Za-z0-9])"), phone),
)
#: Kinds whose patterns find only where to look; the others take each match.
PARTS = {"iban": ibans, "card": cards}


class _Phone:
    """The two layouts of a phone number under one name."""

    def __init__(self, m: re.Match):
        self.m = m

    def __getitem__(self, name):
        return self.m[name] or self.m[name + "2"]


def find(text: str, cipher: Cipher) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, replacement) of the values in a text, in order, none overlapping."""
    has = {"0123456789": re.search(r"[0-9]", text) is not None, "@": "@" in text, "=:": "=" in text or ":" in text}
    has["."] = has["0123456789"]
    taken: list[tuple[int, int, str, str]] = []
    for kind, sign, pattern, change in KINDS:
        if not has[sign]:
            continue
        hits = []
        for m in PARTS[kind](text, pattern) if kind in PARTS else pattern.finditer(text):
            new = change(cipher, _Phone(m) if kind == "phone" else m)
            if new is not None:
                hits.append((m.start(), m.end(), kind, new))
        if hits:  # later kinds see a gap instead
            taken += hits
            cuts = [0, *(x for a, b, _, _ in hits for x in (a, b)), len(text)]
            kept = [text[a:b] for a, b in zip(cuts[::2], cuts[1::2])]
            gaps = [GAP * (b - a) for a, b, _, _ in hits]
            text = "".join(x for pair in zip(kept, [*gaps, ""]) for x in pair)
    return iter(sorted(taken))


def replace(text: str, cipher: Cipher) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its pseudonyms, and (kind, start, end) of each in the new text."""
    out, spans, at, shift = [], [], 0, 0
    for a, b, kind, new in find(text, cipher):
        out += [text[at:a], new]
        spans.append((kind, a + shift, a + shift + len(new)))
        shift += len(new) - (b - a)
        at = b
    return "".join([*out, text[at:]]), spans


def pseudonymise(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", back: bool = False
) -> DataFrame:
    """Per row of ``docs``: identifier, ``text`` with pseudonyms, ``n_replaced``, ``spans``.

    ``back`` undoes a replacement made with the same key. NULL texts stay NULL; texts
    without personal data stay as they are. Repeated rows get equal rows, an empty
    table an empty result; other columns are not read. The key goes to the tasks only.
    """
    need(docs, id_col, text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        cipher = Cipher(key, back)
        for batch in batches:
            texts, found = [], []
            for text in batch["text"].to_pylist():
                new, spans = (None, []) if text is None else replace(text, cipher)
                texts.append(new), found.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(texts, pa.string()), pa.array([len(f) for f in found], pa.int32()),
                 pa.array(found, pa.list_(span))], ["id", "text", "n_replaced", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = f"id {kind}, text string, n_replaced int, spans array<struct<kind: string, start: int, end: int>>"
    return rows.mapInArrow(run, made).withColumnRenamed("id", id_col)
