"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets.

A value that passes its kind's validation (Luhn, mod 97, calendar, octets, ...) is mapped to a number below the size
of its format's domain, permuted there by a keyed Feistel network with cycle walking, and written back in the same
format: equal values get equal pseudonyms in every document, distinct ones distinct, and a pseudonym is valid in
turn. Values of one kind and length are linked even where their separators differ.

Kinds: e-mail addresses (the whole local part), secrets after a key word such as ``token =``, bearer tokens and access key
ids, IBANs, IPv4 addresses, payment cards (13 to 19 digits that pass Luhn), social security numbers, numeric dates of 1900 to 2099 and
telephone numbers (7 to 15 digits in the groups of one). Numbers that fail validation stay. Where two matches overlap, the kind
named first wins.

Letters and digits of a value stay in their alphabet: ASCII and Latin-1 by case, else those of one category within 256 code
points. A value with up to ``WIDE`` bits of such choices is one number; a longer one is permuted as a string by an unbalanced
Feistel network whose halves are added modulo each character's alphabet, so that the time grows with the length alone.

A null text stays null and an empty one empty, with 0 replacements; all other columns stay as they are. Each row is
handled by itself: repeated rows and ids change nothing. Texts and values may be of any length.
"""

from __future__ import annotations

import datetime
import hashlib
import functools
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: For tests and examples. A corpus needs a key of its own, which stays secret.
KEY = b"revlake example key"
ROUNDS = 10
#: Bits of a number that one digest and a spare of 64 bits cover on either side of the network.
WIDE = 256
_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
_ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"]


class Alphabets:
    """Alphabet and place in it of every code point."""

    def __init__(self, alphabets: list[str]):
        self.size, self.place, self.start = np.ones(0x110000, np.int64), np.zeros(0x110000, np.int64), np.arange(0x110000)
        members = [np.array([*map(ord, a)]) for a in alphabets]
        self.points = np.concatenate(members + [np.arange(0x110000)])
        self.start += sum(map(len, members))
        at = 0
        for m in members:
            self.size[m], self.place[m], self.start[m] = len(m), np.arange(len(m)), at
            at += len(m)

    def add(self, others: list[np.ndarray]) -> Alphabets:
        """With further alphabets of characters that none has so far."""
        at = len(self.points)
        self.points = np.concatenate([self.points, *others])
        for m in others:
            self.size[m], self.place[m], self.start[m] = len(m), np.arange(len(m)), at
            at += len(m)
        return self

    def split(self, s: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code points, sizes of their alphabets, places in them)."""
        points = np.frombuffer(s.encode("utf-32-le"), np.uint32).astype(np.int64)
        return points, self.size[points], self.place[points]

    def join(self, points: np.ndarray, place: np.ndarray) -> str:
        return self.points[self.start[points] + place].astype(np.uint32).tobytes().decode("utf-32-le")


@functools.cache
def any_letters() -> Alphabets:
    groups: dict[tuple[str, int], list[int]] = {}
    own = {*map(ord, "".join(_ALPHABETS))}
    for p in range(128, 0x110000):
        if p not in own and chr(p).isalnum():
            groups.setdefault((unicodedata.category(chr(p)), p >> 8), []).append(p)
    return Alphabets(_ALPHABETS).add([np.array(g) for g in groups.values()])


@functools.cache
def hex_digits() -> Alphabets:
    return Alphabets(["0123456789abcdef"])


class Feistel:
    """A keyed permutation of range(n), or of the strings of one format, for each tweak."""

    def __init__(self, key: bytes = KEY, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _halves(self, x: int, half: int, tweak: bytes, order: range) -> int:
        mask = (1 << half) - 1
        size = half // 8 + 9
        left, right = x >> half, x & mask
        backward = order.step < 0
        for r in order:
            if backward:
                left, right = right, left
            digest = hashlib.blake2b(right.to_bytes(half // 8 + 1) + bytes([r, 0]) + tweak, key=self.key).digest()
            left ^= int.from_bytes(digest[:size]) & mask
            if not backward:
                left, right = right, left
        return left << half | right

    def permute(self, x: int, n: int, tweak: bytes, ok: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """Image (or pre-image) of x within the numbers below n that are ok; x is one of them. n has at most ``WIDE`` bits."""
        if n < 2:
            return x
        half = max(1, -(-(n - 1).bit_length() // 2))
        order = range(self.rounds - 1, -1, -1) if back else range(self.rounds)
        while True:
            x = self._halves(x, half, tweak, order)
            if x < n and ok(x):
                return x

    def digits(self, s: str, tweak: bytes, back: bool = False) -> str:
        return str(self.permute(int(s), 10 ** len(s), tweak + b"%d" % len(s), back=back)).zfill(len(s))

    def letters(self, s: str, tweak: bytes, alphabets: Alphabets | None = None, back: bool = False) -> str:
        """Each character stays in its alphabet; others stay as they are."""
        alphabets = alphabets or any_letters()
        points, size, place = alphabets.split(s)
        tweak += alphabets.join(points, np.zeros(len(s), np.int64)).encode()
        free = np.flatnonzero(size > 1)
        if np.log2(size[free]).sum() >= WIDE - 1:
            place[free] = self._string(place[free], size[free], tweak, back)
            return alphabets.join(points, place)
        x, n = 0, 1
        for a, i in zip(size[free].tolist(), place[free].tolist(), strict=True):
            x, n = x * a + i, n * a
        x = self.permute(x, n, tweak, back=back)
        for k in reversed(free.tolist()):
            x, place[k] = divmod(x, int(size[k]))
        return alphabets.join(points, place)

    def _string(self, place: np.ndarray, size: np.ndarray, tweak: bytes, back: bool) -> np.ndarray:
        """The halves take turns: one is hashed with the tweak and the round, and its digest's stream is added to the other."""
        cut = len(place) // 2
        place, size = place.astype(np.int32), size.astype(np.int32)
        halves, sizes = [place[:cut], place[cut:]], [size[:cut], size[cut:]]
        seed = hashlib.blake2b(tweak, key=self.key).digest()
        for r in range(self.rounds - 1, -1, -1) if back else range(self.rounds):
            to, by = r % 2, 1 - r % 2
            digest = hashlib.blake2b(seed + bytes([r]) + halves[by].astype(np.uint8).tobytes(), key=self.key).digest()
            step = np.frombuffer(hashlib.shake_128(digest).digest(2 * len(halves[to])), "<u2").astype(np.int32)
            halves[to] = (halves[to] + (-step if back else step)) % sizes[to]
        return np.concatenate(halves)


def _fill(shape: str, digits: str) -> str:
    """The shape with its digits replaced in order."""
    d = iter(digits)
    return "".join(next(d) if c.isdecimal() else c for c in shape)


def luhn_digit(payload: str) -> str:
    d = [int(c) for c in reversed(payload)]
    return str(-(sum(sum(divmod(2 * x, 10)) for x in d[0::2]) + sum(d[1::2])) % 10)


def _only_digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def _card(m: re.Match, f: Feistel, back: bool) -> str | None:
    d = _only_digits(m[0])
    if luhn_digit(d[:-1]) != d[-1]:
        return None
    payload = f.digits(d[:-1], b"card", back)
    return _fill(m[0], payload + luhn_digit(payload))


def _iban_check(country: str, bban: str) -> str:
    return str(98 - int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97).zfill(2)


def _iban(m: re.Match, f: Feistel, back: bool) -> str | None:
    s = m[0].replace(" ", "")
    country, check, bban = s[:2], s[2:4], s[4:]
    if not 15 <= len(s) <= 34 or _iban_check(country, bban) != check:
        return None
    bban = f.letters(bban, b"iban" + country.encode(), back=back)
    new = iter(country + _iban_check(country, bban) + bban)
    return "".join(c if c == " " else next(new) for c in m[0])


def _ip(m: re.Match, f: Feistel, back: bool) -> str:
    x = f.permute(int.from_bytes(bytes(map(int, m[0].split(".")))), 1 << 32, b"ip", back=back)
    return ".".join(map(str, x.to_bytes(4)))


def _ssn_ok(x: int) -> bool:
    area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(m: re.Match, f: Feistel, back: bool) -> str | None:
    x = int(_only_digits(m[0]))
    return _fill(m[0], str(f.permute(x, 10**9, b"ssn", _ssn_ok, back)).zfill(9)) if _ssn_ok(x) else None


def _read_date(s: str) -> tuple[str, datetime.date] | None:
    """(order of the parts, date): year first, else day first where that is a date, else month first."""
    try:
        parts = [int(x) for x in re.split(r"[-/.]", s)]
        if len(re.split(r"[-/.]", s)[0]) == 4:
            return "ymd", datetime.date(*parts)
        a, b, y = parts
        try:
            return "dmy", datetime.date(y, b, a)
        except ValueError:
            return "mdy", datetime.date(y, a, b)
    except ValueError:
        return None


def _date(m: re.Match, f: Feistel, back: bool) -> str | None:
    read = _read_date(m[0])
    if not read or not _FIRST <= read[1].toordinal() <= _LAST:
        return None
    order, date = read
    widths, seps = [len(x) for x in re.split(r"[-/.]", m[0])], re.findall(r"[-/.]", m[0])

    def render(x: int) -> str:
        d = datetime.date.fromordinal(_FIRST + x)
        parts = [str({"y": d.year, "m": d.month, "d": d.day}[k]).zfill(w) for k, w in zip(order, widths, strict=True)]
        return parts[0] + seps[0] + parts[1] + seps[1] + parts[2]

    def ok(x: int) -> bool:
        return len(render(x)) == len(m[0]) and [len(p) for p in re.split(r"[-/.]", render(x))] == widths and _read_date(render(x))[0] == order

    tweak = f"date{order}{widths if min(widths) < 2 else ''}".encode()
    return render(f.permute(date.toordinal() - _FIRST, _LAST - _FIRST + 1, tweak, ok, back))


def _phone(m: re.Match, f: Feistel, back: bool) -> str | None:
    country = m["country"] or m["plain"] or ""
    rest = m[0][len(country) :]
    d = _only_digits(rest)
    if not 7 <= len(d) <= 15:
        return None
    return country + _fill(rest, f.digits(d, b"phone", back))


def _email(m: re.Match, f: Feistel, back: bool) -> str:
    return f.letters(m["local"], b"email", back=back) + m["domain"]


def _secret(m: re.Match, f: Feistel, back: bool) -> str:
    value = m["value"]
    new = f.letters(value, b"secret", hex_digits() if re.fullmatch(r"[0-9a-f]+", value) else None, back)
    return m[0][: m.start("value") - m.start()] + new + m[0][m.end("value") - m.start() :]


def _key(m: re.Match, f: Feistel, back: bool) -> str | None:
    """A bearer token with a digit in it, or an access key id, whose first four letters stay."""
    if m["id"]:
        return m["id"][:4] + f.letters(m["id"][4:], b"key id", back=back)
    return _secret(m, f, back) if re.search("[0-9]", m["value"]) else None


_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: (kind, a string all its matches have one of, pattern, replacement), in order of precedence.
KINDS: list[tuple[str, str, re.Pattern, Callable]] = [
    ("email", "@", re.compile(r"(?<![\w.+%-])(?P<local>[\w.+%-]++)(?P<domain>@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})"), _email),
    ("secret", "", re.compile(r"(?i)(?<![A-Za-z0-9])(?:token|secret|password|passwd|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key)[\"']?\s{0,4}[=:]\s{0,4}[\"']?(?P<value>[A-Za-z0-9_+/-]{12,}={0,2})"), _secret),
    ("secret", "", re.compile(r"(?<![A-Za-z0-9])(?:[Bb]earer\s{1,4}(?P<value>[A-Za-z0-9_+/.-]{16,}={0,2})|(?P<id>(?:AKIA|ASIA)[A-Z0-9]{16})(?![A-Za-z0-9]))"), _key),
    ("iban", "", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"), _iban),
    ("ip", ".", re.compile(rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"), _ip),
    ("card", "", re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"), _card),
    ("ssn", "-", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"), _ssn),
    ("date", "", re.compile(r"(?<![0-9/.-])(?:[0-9]{4}(?P<s>[-/.])[0-9]{1,2}(?P=s)[0-9]{1,2}|[0-9]{1,2}(?P<t>[-/.])[0-9]{1,2}(?P=t)[0-9]{4})(?![0-9]|[/.-][0-9])"), _date),
    ("phone", "", re.compile(r"(?<![0-9A-Za-z+])(?:(?P<country>\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[.-])[0-9]{3,4}[ .-][0-9]{3,4}|(?P<plain>\+[0-9]{1,3})(?:[ .-]?[0-9]{2,4}){2,5})(?![0-9])"), _phone),
]
_MAYBE = "[0-9@]|AKIA|ASIA|(?i:token|secret|passw|pwd|key)"


def pseudonymise(text: str, f: Feistel, back: bool = False) -> tuple[str, list[str]]:
    """(the text with pseudonyms, kinds replaced in order of place)."""
    taken: list[tuple[int, int, str, str]] = []
    used = bytearray()
    for kind, needs, pattern, replace in KINDS:
        if needs and needs not in text:
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            if 1 not in used[a:b]:
                new = replace(m, f, back)
                if new is not None:
                    used = used or bytearray(len(text))
                    used[a:b] = b"\1" * (b - a)
                    taken.append((a, b, new, kind))
    if not taken:
        return text, []
    taken.sort()
    out, at = [], 0
    for a, b, new, _ in taken:
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:], [k for *_, k in taken]


def _column(text: pa.Array, f: Feistel) -> tuple[pa.Array, list[list[str]]]:
    kinds: list[list[str]] = [[] for _ in range(len(text))]
    rows = np.flatnonzero(pc.fill_null(pc.match_substring_regex(text, _MAYBE), False).to_numpy(zero_copy_only=False))
    if not len(rows):
        return text, kinds
    new = []
    for i, t in zip(rows.tolist(), text.take(pa.array(rows)).to_pylist(), strict=True):
        t, kinds[i] = pseudonymise(t, f)
        new.append(t)
    mask = np.zeros(len(text), bool)
    mask[rows] = True
    return pc.replace_with_mask(text, pa.array(mask), pa.array(new, text.type)), kinds


def pseudonymous(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """(doc_id, text, n_replaced, kinds) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for batch in batches:
            text, kinds = _column(batch.column("text"), f)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text, pa.array([len(k) for k in kinds], pa.int32()), pa.array([sorted(set(k)) for k in kinds], pa.list_(pa.string()))], ["doc_id", "text", "n_replaced", "kinds"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, n_replaced int, kinds array<string>")


def replace_personal(docs: DataFrame, text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """``docs`` with pseudonyms in its text column; all columns stay."""
    place = docs.columns.index(text_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for batch in batches:
            column = batch.column(place)
            yield pa.RecordBatch.from_arrays([_column(column, f)[0] if i == place else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
