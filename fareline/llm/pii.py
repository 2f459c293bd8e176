"""Pseudonyms for personal data that keep its format: keyed Feistel permutations of validated values."""

from __future__ import annotations

import bisect
import datetime
import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

from pyspark.sql import DataFrame

from fareline.llm.common import map_texts

ROUNDS = 10
# Characters that are permuted as one number.
LONGEST_BLOCK = 256


class Permutation:
    """A keyed permutation of 0..size-1: a balanced Feistel network on the next even number of bits, walked
    until the value is in range again."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.half = max(1, -(-(size - 1).bit_length() // 2))
        self.mask = (1 << self.half) - 1
        self.width = -(-self.half // 8)
        told = size.to_bytes(-(-size.bit_length() // 8), "big")
        self.seeded = hashlib.blake2b(tweak.encode() + b":" + told, key=hashlib.sha256(key).digest())

    def _round(self, i: int, x: int) -> int:
        h = self.seeded.copy()
        h.update(bytes([i]) + x.to_bytes(self.width, "big"))
        out = h.digest()
        while len(out) < self.width:
            out += hashlib.blake2b(out).digest()
        return int.from_bytes(out[:self.width], "big") & self.mask

    def _once(self, x: int, rounds: Sequence[int]) -> int:
        left, right = x >> self.half, x & self.mask
        for i in rounds:
            left, right = right, left ^ self._round(i, right)
        return right << self.half | left

    def __call__(self, x: int) -> int:
        return self._walk(x, range(ROUNDS))

    def inverse(self, x: int) -> int:
        return self._walk(x, range(ROUNDS - 1, -1, -1))

    def _walk(self, x: int, rounds: Sequence[int]) -> int:
        if self.size < 2:
            return x
        x = self._once(x, rounds)
        while x >= self.size:
            x = self._once(x, rounds)
        return x


def luhn_digit(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 == 0 else 1)
        total += v - 9 * (v > 9)
    return -total % 10


def iban_check(country: str, account: str) -> int:
    """The two check digits of an IBAN."""
    return 98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97



def _refill(shape: str, new: str) -> str:
    """``shape`` with its letters and digits replaced in order by those of ``new``."""
    fill = iter(new)
    return "".join(next(fill) if c.isascii() and c.isalnum() else c for c in shape)


def _card(found: str, turn) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]) or set(digits) == {"0"}:
        return None
    body = str(turn("card", 10 ** (len(digits) - 1), int(digits[:-1]))).zfill(len(digits) - 1)
    return _refill(found, body + str(luhn_digit(body)))


def _iban(found: str, turn) -> str | None:
    plain = found.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_check(country, account) != int(check):
        return None
    account = _mixed("iban", account, turn)
    return _refill(found, f"{country}{iban_check(country, account):02d}{account}")


def _mixed(tweak: str, text: str, turn) -> str:
    """Digits stay digits and letters letters of their case; other characters stay as they are.

    A long text is permuted in blocks, each by its place and shape, so no number grows with the text.
    """
    if len(text) > LONGEST_BLOCK:
        blocks = (text[at:at + LONGEST_BLOCK] for at in range(0, len(text), LONGEST_BLOCK))
        return "".join(_mixed(f"{tweak}:{i}:{len(text)}", block, turn) for i, block in enumerate(blocks))
    sets = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    kinds = [next((s for s in sets if c in s), None) for c in text]
    size, value = 1, 0
    for c, kind in zip(text, kinds, strict=True):
        if kind:
            size, value = size * len(kind), value * len(kind) + kind.index(c)
    shape = "".join("x" if k is None else k[0] for k in kinds)
    value, out = turn(f"{tweak}:{shape}", size, value), []
    for c, kind in zip(reversed(text), reversed(kinds), strict=True):
        if kind:
            value, i = divmod(value, len(kind))
            c = kind[i]
        out.append(c)
    return "".join(reversed(out))


def _email(found: str, turn) -> str | None:
    local, _, host = found.rpartition("@")
    return f"{_mixed('email:' + host.lower(), local, turn)}@{host}"


def _phone(found: str, turn) -> str | None:
    country, rest = re.match(r"(\+\d{1,3})(.*)", found, re.S).groups()
    digits = re.sub(r"\D", "", rest)
    if not 7 <= len(digits) <= 14:
        return None
    return country + _refill(rest, str(turn(f"phone:{country}", 10 ** len(digits), int(digits))).zfill(len(digits)))


def _address(found: str, turn) -> str | None:
    parts = [int(x) for x in found.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in found.split(".")):
        return None
    value = turn("ipv4", 1 << 32, int.from_bytes(bytes(parts), "big"))
    return ".".join(map(str, value.to_bytes(4, "big")))


def _ssn(found: str, turn) -> str | None:
    area, group, serial = map(int, found.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    areas = [a for a in range(1, 900) if a != 666]
    value = turn("ssn", len(areas) * 99 * 9999, (areas.index(area) * 99 + group - 1) * 9999 + serial - 1)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


_FIRST, _LAST = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)


def _dated(order: str, separator: str):
    def replaced(found: str, turn) -> str | None:
        parts = dict(zip(order, found.split(separator), strict=True))
        try:
            day = datetime.date(int(parts["y"]), int(parts["m"]), int(parts["d"]))
        except ValueError:
            return None
        if not _FIRST <= day <= _LAST:
            return None
        new = _FIRST + datetime.timedelta(turn("date", (_LAST - _FIRST).days + 1, (day - _FIRST).days))
        return separator.join(f"{dict(y=new.year, m=new.month, d=new.day)[c]:0{len(parts[c])}d}" for c in order)

    return replaced


@lru_cache(maxsize=1)
def _late_days() -> list[datetime.date]:
    """The dates that only the order day, month, year can mean when slashed."""
    days = (_FIRST + datetime.timedelta(i) for i in range((_LAST - _FIRST).days + 1))
    return [day for day in days if day.day > 12]


def _slashed(found: str, turn) -> str | None:
    """Month first; day first where the first number is no month, replaced by another of these."""
    if (new := _dated("mdy", "/")(found, turn)) is not None:
        return new
    d, m, y = map(int, found.split("/"))
    try:
        day = datetime.date(y, m, d)
    except ValueError:
        return None
    if not _FIRST <= day <= _LAST or d <= 12:
        return None
    late = _late_days()
    return late[turn("date_dmy", len(late), bisect.bisect_left(late, day))].strftime("%d/%m/%Y")


@dataclass(frozen=True)
class Kind:
    """How values look, and what replaces one that is valid; None leaves it alone."""

    name: str
    pattern: str
    replaced: Callable


KINDS = (
    Kind("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9])",
         _email),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", _iban),
    Kind("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?![\w])", _phone),
    Kind("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])", _card),
    Kind("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    Kind("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", _address),
    Kind("date_iso", r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])", _dated("ymd", "-")),
    Kind("date_dotted", r"(?<![\w.])\d{2}\.\d{2}\.\d{4}(?!\w|\.\d)", _dated("dmy", ".")),
    Kind("date_slashed", r"(?<![\w/])\d{2}/\d{2}/\d{4}(?![\w/])", _slashed),
)
_ANY = re.compile("|".join(f"(?P<{k.name}>{k.pattern})" for k in KINDS), re.ASCII)
# Each pattern whole, and its body and closing look-ahead apart, for matches shorter than the longest.
_PARTS = [(k, re.compile(k.pattern, re.ASCII), re.compile(k.pattern[:at], re.ASCII), re.compile(k.pattern[at:], re.ASCII))
          for k in KINDS for at in [k.pattern.rindex("(?!")]]
_REPLACED = {k.name: k.replaced for k in KINDS}
# What a value and its neighbours can be matched across.
_JOINING = re.compile(r"[A-Za-z0-9 ._%+@()/-]*")
_TRIGGER = re.compile(r"[0-9@]")


class Pseudonyms:
    """Replacement of all personal values of a text under one key."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.inverse = key, inverse
        self.permutations: dict[tuple[str, int], Permutation] = {}

    def _turn(self, tweak: str, size: int, value: int) -> int:
        if (tweak, size) not in self.permutations:
            if len(self.permutations) > 10_000:
                self.permutations.clear()
            self.permutations[tweak, size] = Permutation(self.key, tweak, size)
        permutation = self.permutations[tweak, size]
        return permutation.inverse(value) if self.inverse else permutation(value)

    def __call__(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The new text and ``kind, start, end`` of each value in the old one."""
        if not _TRIGGER.search(text):
            return text, []
        values = self._values(text)
        if not values:
            return text, []
        runs = [0]
        for (_, _, end, _), (_, start, _, _) in pairwise(values):
            runs.append(runs[-1] + (_JOINING.fullmatch(text, end, start) is None))
        new = [v[3] for v in values]
        # The new text must be read like the old one. Where it is not, as neighbouring digits happen to complete a
        # check digit, the values of that stretch are replaced again until it is; the inverse comes back the same way.
        while True:
            out, at = [], 0
            for (_, start, end, _), value in zip(values, new, strict=True):
                out += [text[at:start], value]
                at = end
            result = "".join([*out, text[at:]])
            wanted = [(v[0], value) for v, value in zip(values, new, strict=True)]
            read = self._values(result)
            told = [(kind, result[start:end]) for kind, start, end, _ in read]
            if told == wanted:
                return result, [v[:3] for v in values]
            first = next((i for i, (x, y) in enumerate(zip(told, wanted)) if x != y), min(len(told), len(wanted) - 1))
            again = runs[first]
            new = [_REPLACED[v[0]](value, self._turn) if run == again else value
                   for v, value, run in zip(values, new, runs, strict=True)]

    def _values(self, text: str) -> list[tuple[str, int, int, str]]:
        """``kind, start, end, replacement`` of each valid value."""
        found, search = [], 0
        while (m := _ANY.search(text, search)):
            value = self._at(text, m.start())
            if value:
                found.append(value)
                search = value[2]
                continue
            # A run that is no value may still be followed by one further on.
            search = m.start() + 1
            while search < len(text) and text[search].isalnum() and text[search - 1].isalnum():
                search += 1
        return found

    def _at(self, text: str, start: int) -> tuple[str, int, int, str] | None:
        """The first kind that has a valid value at a position, the longest of them."""
        for kind, whole, body, tail in _PARTS:
            m = whole.match(text, start)
            if not m:
                continue
            for end in range(m.end(), start, -1):
                if end < m.end() and not (tail.match(text, end) and body.fullmatch(text, start, end)):
                    continue
                if (new := kind.replaced(text[start:end], self._turn)) is not None:
                    return kind.name, start, end, new
        return None


def pseudonymize(docs: DataFrame, key: bytes, inverse: bool = False, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text, found``, the text with every personal value replaced in its format.

    Emails (their local part), IBANs, phone numbers with country code, card numbers, US social security numbers, IPv4
    addresses and dates are taken if they are valid: check digits, ranges and calendar hold; the like that is
    not valid stays. Where the longest value of a kind is not valid, shorter ones and the other kinds are tried at the
    same place. Slashed dates are read month first, or day first if only that is a date. A replacement is valid in the same format, and the same value has the same replacement in every
    document under the same key, whatever its separators (slashed dates that only day first can mean are apart from the others, and so are the rare
    values next to digits that they would complete a check digit with); with ``inverse`` the old values come back.
    ``found`` lists ``kind, start, end`` in the old text.

    Whole texts are read; null stays null, an empty text empty; repeated rows come out alike; an empty table gives
    an empty result. One pass, no shuffle and no table of values: the key is all that links documents.
    """

    def each(ids: list, texts: list) -> dict:
        replace = Pseudonyms(key, inverse)
        done = [(None, []) if t is None else replace(t) for t in texts]
        return {"doc_id": ids, "text": [d[0] for d in done], "found": [
            [{"kind": k, "start": s, "end": e} for k, s, e in d[1]] for d in done]}

    return map_texts(docs, each, "doc_id long, text string, found array<struct<kind:string,start:long,end:long>>",
                     id_col, text_col)
