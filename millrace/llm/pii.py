"""Format-preserving pseudonyms for personal data and secrets.

A value found in a text is read as a number in the mixed radix of its own format, validated (Luhn, IBAN mod 97, calendar, octets,
social security areas) and replaced by its image under a keyed permutation of the values of that format with the same validity.
The permutation is E^-1(E(x) + 1) for a keyed Feistel network E, so a value never stays unless it is the only one of its class,
equal values get equal pseudonyms in every document and every spelling of their separators, and whoever has the key can undo it.
Values of one format and validity never collide.

Formats: every character keeps its class (digit, letter of its case, separator), and so the length stays. Beyond that
  * strings of digits and a-f (of one case, with a letter) stay such strings, AKIA keys keep their prefix, digits stay digits;
  * dates are one permutation for all their spellings; it keeps whether the day is below 10, 10 to 12 or above 12, whether the
    month is below 10, and whether the year is in 1900-2099, so that one-digit fields stay one digit and a date that only US
    order can read stays one; years 0001 to 9999 take part, a slash date is read day first where both orders can;
  * octets of an address stay in 0-9, 10-99 or 100-255 (the first also below or above 224), padded or not; four numbers after
    the word "version" or "release" aren't an address;
  * an IBAN's check digits are 02 to 98 (others name the same account twice and aren't valid), a card keeps its issuer's range.

An IBAN ends at its country's length, a card where 13 to 19 digits at the borders of their groups pass Luhn, cards of known
issuers in usual groups first. A string that fails validation is tried at its shorter lengths and as the other kinds from the
same place. Where digits side by side can be split into cards in several ways, undoing may split the pseudonyms in another way.

Defined results: a null text stays null, an empty one empty; a text without values is returned as it is, whatever its length, and
a long one is scanned whole, its memory being a few times its size and its time in proportion to it (strings of more than LONG
characters are permuted by a network over their places instead of one over numbers); of values that begin at the same place the kind named first
in KINDS wins; repeated rows get equal results; an empty table gives an empty table; all other columns are kept (pii_report
returns its own columns alone).
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices

#: For tests and registered queries; a deployment passes its own secret key.
DEMO_KEY = b"millrace demonstration key"
ROUNDS = 10
#: Years of one class of dates; all others from 1 to 9999 are the second class.
_MODERN = range(1900, 2100)
#: Days and months that stay among themselves.
_DAYS, _MONTHS = (range(1, 10), range(10, 13), range(13, 32)), (range(1, 10), range(10, 13))
#: Values of an octet that stay among themselves, and those of an address' first octet.
_OCTETS = (range(10), range(10, 100), range(100, 256))
_FIRST_OCTETS = (range(1), range(1, 10), range(10, 100), range(100, 224), range(224, 256))
_VERSION = re.compile(r"(?i)\b(?:version|release)\s*$")

#: Without one of these a text has no value.
_SOME = re.compile("[0-9@=:]|AKIA|[a-f]{32}|[A-F]{32}")
#: Tried in this order where they begin at the same place, e-mails behind secrets; none begins inside a run of letters and digits.
_PATTERNS = {
    "secret": r"""(?i:\b(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)\b\s*[:=]\s*["']?)(?P<secret>[A-Za-z0-9+/_=-]{8,})""",
    "iban": r"(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "hex": r"(?P<hex>(?:[0-9a-f]{32,}|[0-9A-F]{32,})|AKIA[0-9A-Z]{16})(?![A-Za-z0-9])",
    "ip": r"(?<!\.)(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\.?[0-9])",
    "ymd": r"(?<!-)(?P<ymd>[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9-])",
    "dmy": r"(?<![/.])(?P<dmy>[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9])",
    "ssn": r"(?<!-)(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])",
    "card": r"(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?![0-9])",
    "phone": r"(?P<phone>\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])",
}
_GUARD = "(?<![A-Za-z0-9])"
_FIND = re.compile(f"{_GUARD}(?:{'|'.join(_PATTERNS.values())})")
_ALONE = {kind: re.compile(_GUARD + pattern) for kind, pattern in _PATTERNS.items()}
KINDS = ("secret", "email", "iban", "hex", "ip", "ymd", "dmy", "ssn", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
#: The registry's lengths.
_IBAN = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG YE",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
#: Issuers' first digits with their lengths.
_ISSUER = re.compile("4(?:.{12}|.{15}|.{18})|5[1-5].{14}|2(?:22[1-9]|2[3-9].|[3-6]..|7[01].|720).{12}|3[47].{13}|3(?:0[0-5]|[689].).{11,16}|35.{14,17}|(?:50|5[6-8]|6.).{11,17}")
_GROUP, _RUN = re.compile("[0-9]+"), re.compile("[0-9]+(?:[ -][0-9]+)*")
_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}


_DIGITS, _HEX, _HEX_UPPER = set("0123456789"), set("abcdef"), set("ABCDEF")
#: Strings of more characters are permuted as wide ones.
LONG = 256


class Emails:
    """Addresses of a text, each found from its @ outwards, so that every character is read twice at most."""

    def __init__(self, text: str):
        self.text, self.at, self.end = text, -1, 0
        self._advance()

    def _advance(self) -> None:
        last, self.at = self.at, self.text.find("@", self.at + 1)
        if self.at >= 0:
            self.start = last + 1 + len(self.text[last + 1 : self.at].rstrip(_LOCAL))
            m = _DOMAIN.match(self.text, self.at + 1)
            self.end = m.end() if m else 0

    def after(self, pos: int) -> tuple[int, int] | None:
        """Start and end of the first address that begins at pos or later; pos never falls from call to call."""
        while self.at >= 0:
            start = max(pos, self.start)
            if self.end and start < self.at:
                return start, self.end
            self._advance()
        return None


class Permutation:
    """A keyed permutation of range(size) without a fixed point, for any size from 2 on."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.half = max(1, (max(1, (size - 1).bit_length()) + 1) // 2)
        self.mask, self.width = (1 << self.half) - 1, (self.half + 7) // 8
        self.key = hashlib.blake2b(f"{tweak}|{size}".encode(), key=key[:64]).digest()

    def _round(self, i: int, x: int) -> int:
        raw, block = b"", 0
        while len(raw) < self.width:
            raw += hashlib.blake2b(bytes([i, block]) + x.to_bytes(self.width, "big"), key=self.key, digest_size=min(64, max(8, self.width))).digest()
            block += 1
        return int.from_bytes(raw[: self.width], "big") & self.mask

    def _walk(self, x: int, rounds) -> int:
        while True:  # values outside the range are passed on until one falls inside
            a, b = x >> self.half, x & self.mask
            if rounds.step > 0:
                for i in rounds:
                    a, b = b, a ^ self._round(i, b)
            else:
                for i in rounds:
                    a, b = b ^ self._round(i, a), a
            x = a << self.half | b
            if x < self.size:
                return x

    def encrypt(self, x: int) -> int:
        return self._walk(x, range(ROUNDS))

    def decrypt(self, x: int) -> int:
        return self._walk(x, range(ROUNDS - 1, -1, -1))

    def __call__(self, x: int) -> int:
        return self.decrypt((self.encrypt(x) + 1) % self.size) if self.size > 1 else x

    def undo(self, x: int) -> int:
        return self.decrypt((self.encrypt(x) - 1) % self.size) if self.size > 1 else x


class WidePermutation:
    """A keyed permutation of long strings of digits with the given radices, without a fixed point, in linear time: a Feistel
    network whose halves are added place by place to a key stream made from the other half; then as in Permutation."""

    def __init__(self, key: bytes, tweak: str, radices: np.ndarray):
        self.radices, self.half = radices, len(radices) // 2
        self.key = hashlib.blake2b(f"wide|{tweak}|{len(radices)}".encode(), key=key[:64]).digest()

    def _rounds(self, x: np.ndarray, back: bool) -> np.ndarray:
        x, low, high = x.copy(), slice(0, self.half), slice(self.half, len(x))
        for i in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            to, of = (low, high) if i % 2 else (high, low)
            r = self.radices[to]
            stream = np.frombuffer(hashlib.shake_256(self.key + bytes([i]) + x[of].astype(np.uint8).tobytes()).digest(2 * len(r)), "<u2") % r
            x[to] = (x[to] + (r - stream if back else stream)) % r
        return x

    def _add(self, x: np.ndarray, step: int) -> np.ndarray:
        """The next (step 1) or last (step -1) string: all places behind the last one that doesn't overflow turn over."""
        x, ends = x.copy(), (self.radices - 1) if step > 0 else np.zeros_like(x)
        stay = np.flatnonzero(x != ends)
        last = stay[-1] if len(stay) else -1
        x[last + 1 :] = (self.radices - 1 - ends)[last + 1 :]
        if last >= 0:
            x[last] += step
        return x

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._rounds(self._add(self._rounds(x, False), 1), True)

    def undo(self, x: np.ndarray) -> np.ndarray:
        return self._rounds(self._add(self._rounds(x, False), -1), True)


def _radix(c: str, letters: int = 26) -> int:
    return 10 if c.isdigit() else letters if "a" <= c.lower() <= "z" else 1


def _read(chars: str, letters: int = 26) -> tuple[int, int]:
    """A string's number in the mixed radix of its characters, and how many such numbers there are."""
    x, size = 0, 1
    for c in chars:
        r = _radix(c, letters)
        if r > 1:
            x = x * r + (ord(c) - 48 if r == 10 else ord(c.lower()) - 97)
            size *= r
    return x, size


def _write(x: int, like: str, letters: int = 26) -> str:
    out = []
    for c in reversed(like):
        r = _radix(c, letters)
        if r == 1:
            out.append(c)
            continue
        x, d = divmod(x, r)
        out.append(chr(48 + d) if r == 10 else chr((97 if c.islower() else 65) + d))
    return "".join(reversed(out))


def _mixed(places: list[tuple[int, range]]) -> tuple[int, int]:
    """(value, its range) for each place: the number in the mixed radix of the ranges, and how many there are."""
    x, size = 0, 1
    for v, among in places:
        x, size = x * len(among) + v - among.start, size * len(among)
    return x, size


def _unmixed(x: int, ranges: list[range]) -> list[int]:
    out = []
    for among in reversed(ranges):
        x, d = divmod(x, len(among))
        out.append(among[d])
    return out[::-1]


def is_hex(v: str) -> bool:
    """Digits and a-f of one case, with a letter."""
    met = set(v) - _DIGITS
    return bool(met) and (met <= _HEX or met <= _HEX_UPPER)


def is_access_key(v: str) -> bool:
    return re.fullmatch("AKIA[0-9A-Z]{16}", v) is not None


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    return "02" <= value[2:4] <= "98" and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def calendar_has(y: int, m: int, d: int) -> bool:
    try:
        datetime.date(y, m, d)
    except ValueError:
        return False
    return True


def iban_ends(text: str, start: int, end: int) -> list[int]:
    """Where an IBAN from start on may end and has right check digits: by its country's length, else where groups end, the furthest
    (end) first."""
    length, ends, n, rest = _IBAN.get(text[start : start + 2]), [], 4, 0
    head = int(f"{int(text[start], 36)}{int(text[start + 1], 36)}{text[start + 2 : start + 4]}") % 97
    if not "02" <= text[start + 2 : start + 4] <= "98":
        return []
    for i in range(start + 4, end):
        c = text[i]
        if c == " ":
            continue
        n += 1
        d = int(c, 36)
        rest = (rest * (10 if d < 10 else 100) + d) % 97
        if n > 11 and (rest * 1_000_000 + head) % 97 == 1 and (i + 1 == end or not text[i + 1].isalnum()) and (n == length or length is None or i + 1 == end):
            ends.append((n == length, i + 1))
    return [e for _, e in sorted(ends, reverse=True)]


def cards(text: str, start: int) -> dict[int, list[tuple]]:
    """For every group of digits in the run from start on, the valid cards from there: (rank, start, end), best first."""
    spans = [m.span() for m in _GROUP.finditer(text, start, _RUN.match(text, start).end())]
    plain = "".join(text[a:b] for a, b in spans)
    at, kept, twice = [0], [0, 0], [0, 0]  # sums over every other digit, as they are and as Luhn doubles them
    for a, b in spans:
        at.append(at[-1] + b - a)
    for c in plain:
        d = int(c)
        kept.append(kept[-2] + d)
        twice.append(twice[-2] + 2 * d - 9 * (d > 4))
    out = {}
    for i, (begin, _) in enumerate(spans):
        found = out[begin] = []
        for j in range(i, len(spans)):
            x, y = at[i], at[j + 1]
            n = y - x
            if n > 19:
                break
            # kept[k + 2] ends with digit k
            if n > 12 and (kept[y + 1] - kept[x + 1 - (n % 2 == 1)] + twice[y] - twice[x + (n % 2 == 1)]) % 10 == 0:
                usual = i == j or tuple(b - a for a, b in spans[i : j + 1]) in _GROUPS and len({text[a - 1] for a, _ in spans[i + 1 : j + 1]}) == 1
                known = issuer(plain[x:y])
                found.append(((0 if usual and known else 1 if usual else 2 if known else 3, usual and n != 16, -n), begin, spans[j][1]))
        found.sort()
    return out


def issuer(digits: str) -> bool:
    return _ISSUER.fullmatch(digits) is not None


class Pseudonyms:
    """Pseudonyms under one key; undo=True gives the values back."""

    def __init__(self, key: bytes, undo: bool = False):
        self.undo, self.secret = undo, key
        self.permutation = lru_cache(4096)(lambda tweak, size: Permutation(key, tweak, size))
        self._kept = lru_cache(20_000)(self._value)

    def value(self, kind: str, v: str) -> str | None:
        """The pseudonym, or None if the string isn't a value of its kind; short ones are remembered."""
        return self._kept(kind, v) if len(v) <= LONG else self._value(kind, v)

    def _step(self, tweak: str, x: int, size: int) -> int:
        p = self.permutation(tweak, size)
        return p.undo(x) if self.undo else p(x)

    def _chars(self, tweak: str, value: str, same: Callable[[str], object] = lambda v: None, letters: int = 26) -> str:
        """The next value of the format for which `same` says what it says of this one."""
        if len(value) > LONG:
            return self._wide(tweak, value, same, letters)
        x, size = _read(value, letters)
        if size < 2:
            return value
        kind = same(value)
        tweak += "|" + "".join({10: "9", 1: ""}.get(_radix(c), "a") for c in value)
        while True:
            x = self._step(tweak, x, size)
            out = _write(x, value, letters)
            if same(out) == kind:
                return out

    def _wide(self, tweak: str, value: str, same: Callable[[str], object], letters: int) -> str:
        """As _chars for long strings; what isn't a letter or digit stays in its place."""
        raw = np.frombuffer(value.encode(), np.uint8)
        digit, lower, upper = (raw >= 48) & (raw < 58), (raw >= 97) & (raw < 123), (raw >= 65) & (raw < 91)
        free = digit | lower | upper
        base = (48 * digit + 97 * lower + 65 * upper).astype(np.uint8)[free]
        radices = np.where(digit, 10, letters)[free]
        if len(radices) < 2:
            return value
        kind, x, out = same(value), (raw[free] - base).astype(np.int64), raw.copy()
        p = WidePermutation(self.secret, f"{tweak}|{hashlib.blake2b(radices.astype(np.uint8).tobytes()).hexdigest()}", radices)
        while True:
            x = p.undo(x) if self.undo else p(x)
            out[free] = x + base
            if same(text := out.tobytes().decode()) == kind:
                return text

    def _digits(self, tweak: str, value: str, same: Callable[[str], object] = lambda v: None) -> str:
        """As _chars for the digits alone, so that separators make no difference."""
        found = iter(self._chars(tweak, re.sub("[^0-9]", "", value), same))
        return re.sub("[0-9]", lambda _: next(found), value)

    def _places(self, tweak: str, places: list[tuple[int, range]], valid: Callable[[list[int]], bool] = lambda v: True) -> list[int]:
        """The next valid values, each in its own range."""
        ranges = [among for _, among in places]
        x, size = _mixed(places)
        tweak += "|" + ",".join(f"{r.start}-{r.stop}" for r in ranges)
        while size > 1:
            x = self._step(tweak, x, size)
            if valid(out := _unmixed(x, ranges)):
                return out
        return [v for v, _ in places]

    def _date(self, y: int, m: int, d: int) -> list[int]:
        """The pseudonym of a date of the calendar: year, month, day. Years outside 1900-2099 close ranks around them."""
        days, months = (next(r for r in rs if x in r) for x, rs in ((d, _DAYS), (m, _MONTHS)))
        years, gap = (_MODERN, 0) if y in _MODERN else (range(1, 10_000 - len(_MODERN)), len(_MODERN))
        real = lambda x: x + gap if x >= _MODERN.start else x
        year = (y - gap if y >= _MODERN.start else y) if gap else y
        out = self._places("date", [(year, years), (m, months), (d, days)], lambda v: calendar_has(real(v[0]) if gap else v[0], *v[1:]))
        return [real(out[0]) if gap else out[0], *out[1:]]

    def _token(self, v: str) -> str:
        """A secret or a long hexadecimal string."""
        if is_access_key(v):
            return v[:4] + self._chars("access", v[4:])
        if is_hex(v):
            return self._chars("hex", v, is_hex, 6)
        return self._chars("secret", v, lambda x: is_hex(x) or is_access_key(x))

    def _value(self, kind: str, v: str) -> str | None:
        """The pseudonym, or None if the string isn't a value of its kind."""
        if kind in ("secret", "hex"):
            return self._token(v)
        if kind == "email":
            local, _, domain = v.partition("@")
            *labels, top = domain.split(".")
            return ".".join([self._chars("local", local) + "@" + self._chars("domain", labels[0]), *(self._chars("domain", x) for x in labels[1:]), top])
        if kind == "iban":
            plain = v.replace(" ", "")
            if not iban(plain):
                return None
            # the account part decides; the check digits follow
            account = self._chars("iban" + plain[:2], plain[4:])
            check = 98 - int("".join(str(int(c, 36)) for c in account + plain[:2] + "00")) % 97
            out = iter(f"{plain[:2]}{check:02d}{account}")
            return "".join(c if c == " " else next(out) for c in v)
        if kind == "ip":
            parts = v.split(".")
            if max(map(int, parts)) > 255:
                return None
            places = [(int(x), next(r for r in (_OCTETS if i else _FIRST_OCTETS) if int(x) in r)) for i, x in enumerate(parts)]
            return ".".join(f"{new:0{len(x)}d}" for new, x in zip(self._places("ip", places), parts))
        if kind in ("ymd", "dmy"):
            fields = re.split("[-/.]", v)
            a, b, c = map(int, fields)
            for order in ((0, 1, 2),) if kind == "ymd" else ((2, 1, 0), (2, 0, 1)):
                y, m, d = ((a, b, c)[i] for i in order)
                if calendar_has(y, m, d):
                    new = dict(zip(order, self._date(y, m, d)))
                    sep = re.search("[-/.]", v)[0]
                    return sep.join(f"{new[i]:0{len(fields[i])}d}" for i in range(3))
            return None
        if kind == "ssn":
            return self._digits("ssn", v, ssn)
        if kind == "card":
            d = re.sub("[^0-9]", "", v)
            if not luhn(d):
                return self._digits("number", v, luhn)
            payload = self._chars("card", d[:-1], lambda x: issuer(x + "0"))
            new = iter(payload + next(c for c in "0123456789" if luhn(payload + c)))
            return re.sub("[0-9]", lambda _: next(new), v)
        m = re.match(r"\+[0-9]{1,3}(?=[ .(-])", v)
        head = m[0] if m else ""
        return head + self._digits("phone" + head, v[len(head) :])

    def text(self, text: str | None) -> tuple[str | None, list[str]]:
        """The text with pseudonyms and the kinds of the values replaced, in their order."""
        if not text or not _SOME.search(text):
            return text, []
        kinds: list[str] = []

        out, pos, done = [], 0, 0
        self.run: dict[int, list[tuple]] = {}
        emails, m = Emails(text), _FIND.search(text)
        while True:
            if m and m.start() < pos:
                m = _FIND.search(text, pos)
            email = emails.after(pos)
            if email and (m is None or email[0] < m.start() or email[0] == m.start() and m["secret"] is None):
                hit = ("email", *email, self.value("email", text[slice(*email)]))
            elif m:
                hit = self._hit(text, m)
            else:
                break
            if hit is None:  # another value may begin inside
                pos = m.start() + 1
                continue
            kind, start, pos, new = hit
            kinds.append(kind)
            out += text[done:start], new
            done = pos
        return "".join(out) + text[done:], kinds

    def _card(self, text: str, start: int, end: int) -> tuple[int | None, int]:
        """The end of the card from start on, None if there is none, and where before end a better one begins (the text's end: none)."""
        if start not in self.run:
            self.run = cards(text, start)
        own = self.run[start][0] if self.run[start] else None
        near = [self.run[g.start()] for g in islice(_GROUP.finditer(text, start, own[2] if own else end), 1, None)]
        better = [c[0] for c in near if c and (own is None or c[0][0][0] < own[0][0])]
        return (None, min(better)[1]) if better else (own[2] if own else None, len(text))

    def _hit(self, text: str, m: re.Match) -> tuple[str, int, int, str] | None:
        """Kind, start, end and pseudonym of the value where m begins."""
        first = m.lastgroup
        limit, kinds = len(text), list(_PATTERNS)
        for kind in ("iban", "hex") if first == "iban" else kinds[kinds.index(first) :]:  # others don't begin with letters
            found = m if kind == first else _ALONE[kind].match(text, m.start())
            if found is None:
                continue
            start, end = found.span(kind)
            ends = [end]
            if kind == "iban":
                ends = iban_ends(text, start, end)
            elif kind == "ip" and _VERSION.search(text, max(0, start - 16), start):
                continue
            elif kind == "card":
                own, limit = self._card(text, start, end)
                if own is None and limit < end:  # other digits stay a number if the card leaves enough of them
                    found = _ALONE[kind].match(text, start, limit)
                ends = [own] if own else [found.end()] if found else []
            elif kind == "phone":
                for g in _GROUP.finditer(text, start + 1, end):
                    c = _ALONE["card"].match(text, g.start())
                    if c and (self._card(text, *c.span())[0] or 0) > end:
                        limit = min(limit, g.start())
                if limit < end:
                    found = _ALONE[kind].match(text, start, limit)
                    ends = [found.end()] if found else []
            for end in ends:
                if (new := self.value(kind, text[start:end])) is not None:
                    return kind, start, end, new
        return None


def pseudonymize(docs: DataFrame, key: bytes = DEMO_KEY, text: str = "text", undo: bool = False) -> DataFrame:
    """docs with pseudonyms in its texts; the columns stay as they are."""

    def make():
        p = Pseudonyms(key, undo)

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.schema.get_field_index(text)
            return batch.set_column(at, batch.schema.field(at), pa.array([p.text(t)[0] for t in batch.column(at).to_pylist()], batch.schema.field(at).type))

        return part

    return map_slices(docs, make, docs.schema, text)


def pii_report(docs: DataFrame, key: bytes = DEMO_KEY, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_values, the kinds found (distinct, sorted, comma-joined) and the whole pseudonymised text, for every row."""

    def make():
        p = Pseudonyms(key)

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [p.text(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(k) for _, k in found], pa.int64()), pa.array([",".join(sorted(set(k))) for _, k in found], pa.string()), pa.array([t for t, _ in found], pa.string())], [id_column, "n_values", "kinds", "text"])

        return part

    return map_slices(docs.select(id_column, F.col(text).alias("text")), make, f"{id_column} {docs.schema[id_column].dataType.simpleString()}, n_values long, kinds string, text string", "text")
