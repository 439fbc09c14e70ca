"""Personal data: values with a checked format are replaced by keyed permutations inside their format."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import slices

ROUNDS = 10
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
#: Days from 1900-01-01 to 2099-12-31.
FIRST_DAY, DAYS = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal() - date(1900, 1, 1).toordinal() + 1
VALUE = re.compile(rf"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]*[A-Za-z0-9_])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{{2,}})
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{{2}}\d{{2}}(?:\ ?[A-Z0-9]{{4}}){{2,7}}(?:\ ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))
  | (?P<secret>(?<![0-9A-Za-z])(?:[0-9a-f]{{32,}}|[0-9A-F]{{32,}})(?![0-9A-Za-z]))
  | (?P<ymd>(?<![\d./-])\d{{4}}(?P<s1>[-/.])\d{{1,2}}(?P=s1)\d{{1,2}}(?![./-]?\d))
  | (?P<dmy>(?<![\d./-])\d{{1,2}}(?P<s2>[-/.])\d{{1,2}}(?P=s2)\d{{4}}(?![./-]?\d))
  | (?P<named>(?<!\w)(?:\d{{1,2}}\ (?:{"|".join(MONTHS)})|(?:{"|".join(MONTHS)})\ \d{{1,2}},)\ \d{{4}}(?!\w))
  | (?P<ssn>(?<![\d-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]))
  | (?P<ip>(?<![\d.])\d{{1,3}}(?:\.\d{{1,3}}){{3}}(?!\.?\d))
  | (?P<card>(?<![\d-])\d(?:[\ -]?\d){{12,18}}(?![\d-]))
  | (?P<phone>(?<![\w+])(?:\+\d{{1,3}}[\ .-]?)?(?:\(\d{{2,4}}\)[\ .-]?|\d{{2,4}}[\ .-])\d{{3,4}}[\ .-]\d{{3,4}}(?!\w)|(?<![\w+])\+\d{{8,15}}(?!\w))
""", re.X)
ANY = re.compile(r"[0-9@]")
#: Characters of an IBAN by country, from the registry.
IBAN_SIZES = {k: n for n, names in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for k in names.split()}


class Permuter:
    """Keyed permutations of the numbers below n that move every number, one for each n and format.

    A Feistel network over two unequal halves (each round adds a keyed hash of one half to the other) permutes a range
    hardly larger than n; numbers outside walk on until they are back inside. Shifting by one between the network and
    its inverse leaves no number in its place.
    """

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def _rounds(self, x: int, n: int, form: str, back: bool) -> int:
        a = 1 << ((n - 1).bit_length() + 1) // 2
        b = -(-n // a)
        left, right = x % a, x // a
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            source = right if r % 2 == 0 else left
            mark = f"{form}|{n}|{r}|{source}".encode()
            add = int.from_bytes(blake2b(mark, key=self.key, digest_size=64).digest())
            add = -add if back else add
            if r % 2 == 0:
                left = (left + add) % a
            else:
                right = (right + add) % b
        return left + a * right

    def _walk(self, x: int, n: int, form: str, back: bool) -> int:
        x = self._rounds(x, n, form, back)
        while x >= n:
            x = self._rounds(x, n, form, back)
        return x

    def move(self, x: int, n: int, form: str, step: int = 1) -> int:
        """Another number below n; `step` -1 undoes it. With a single number there is nothing to move."""
        if n < 2:
            return x
        return self._walk((self._walk(x, n, form, False) + step) % n, n, form, True)

    def characters(self, text: str, form: str, step: int = 1) -> str:
        """Letters become letters of the same case, digits digits; everything else stays in its place."""
        value, size, kinds = 0, 1, []
        for c in text:
            base = 10 if "0" <= c <= "9" else 26 if "a" <= c.lower() <= "z" and c.isascii() else 0
            kinds.append(base)
            if base:
                value, size = value * base + (ord(c.lower()) - (48 if base == 10 else 97)), size * base
        value = self.move(value, size, f"{form}|{''.join('d' if k == 10 else 'a' if k else c for k, c in zip(kinds, text))}", step)
        out = []
        for c, base in zip(reversed(text), reversed(kinds)):
            if base:
                value, digit = divmod(value, base)
                new = chr(digit + (48 if base == 10 else 97))
                c = new.upper() if c.isupper() else new
            out.append(c)
        return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for valid card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total


def fill(form: str, digits: str) -> str:
    """`form` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if "0" <= c <= "9" else c for c in form)


def email(p: Permuter, text: str, step: int) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{p.characters(local, 'email@' + domain.lower(), step)}@{domain}"


def iban(p: Permuter, text: str, step: int) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = p.characters(plain[4:], "iban" + plain[:2], step)
    new = iter(f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def secret(p: Permuter, text: str, step: int) -> str | None:
    if text.isdigit() or text.isalpha():
        return None
    new = f"{p.move(int(text, 16), 16 ** len(text), 'secret', step):0{len(text)}x}"
    return new.upper() if text.upper() == text else new


def day(p: Permuter, year: int, month: int, number: int, step: int) -> date | None:
    try:
        at = date(year, month, number).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return date.fromordinal(FIRST_DAY + p.move(at, DAYS, "date", step)) if 0 <= at < DAYS else None


def padded(value: int, like: str) -> str:
    """Two digits if the example has a leading zero or needs both."""
    return f"{value:02d}" if len(like) == 2 else str(value)


def ymd(p: Permuter, text: str, step: int) -> str | None:
    y, m, d = re.split(r"[-/.]", text)
    new = day(p, int(y), int(m), int(d), step)
    return new and f"{new.year}{text[4]}{padded(new.month, m)}{text[4]}{padded(new.day, d)}"


def dmy(p: Permuter, text: str, step: int) -> str | None:
    a, b, y = re.split(r"[-/.]", text)
    mark = text[len(a)]
    # Day first, unless only the other reading is a date.
    new = day(p, int(y), int(b), int(a), step)
    if new:
        return f"{padded(new.day, a)}{mark}{padded(new.month, b)}{mark}{new.year}"
    # Month first: on to a day that only reads this way, too.
    new = day(p, int(y), int(a), int(b), step)
    while new and new.day <= 12:
        new = day(p, new.year, new.month, new.day, step)
    return new and f"{padded(new.month, a)}{mark}{padded(new.day, b)}{mark}{new.year}"


def named(p: Permuter, text: str, step: int) -> str | None:
    parts = text.replace(",", "").split(" ")
    first = parts[0].isdigit()
    d, m = (parts[0], parts[1]) if first else (parts[1], parts[0])
    new = day(p, int(parts[2]), MONTHS.index(m) + 1, int(d), step)
    if not new:
        return None
    month, number = MONTHS[new.month - 1], str(new.day)
    return f"{number} {month} {new.year}" if first else f"{month} {number}, {new.year}"


def ssn(p: Permuter, text: str, step: int) -> str | None:
    a, g, s = map(int, text.split("-"))
    if a in (0, 666) or a >= 900 or not g or not s:
        return None
    area = a - 1 - (a > 666)
    x = p.move((area * 99 + g - 1) * 9999 + s - 1, 898 * 99 * 9999, "ssn", step)
    x, s = divmod(x, 9999)
    area, g = divmod(x, 99)
    return f"{area + 1 + (area >= 665):03d}-{g + 1:02d}-{s + 1:04d}"


def ip(p: Permuter, text: str, step: int) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    x = p.move(int.from_bytes(bytes(parts)), 1 << 32, "ip", step)
    return ".".join(map(str, x.to_bytes(4)))


def card(p: Permuter, text: str, step: int) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn(digits) % 10 or len(set(digits)) == 1:
        return None
    body = f"{p.move(int(digits[:-1]), 10 ** (len(digits) - 1), f'card{len(digits)}', step):0{len(digits) - 1}d}"
    new = f"{body}{-luhn(body + '0') % 10}"
    return fill(text, new)


def phone(p: Permuter, text: str, step: int) -> str | None:
    """The country code stays; all digits behind it are permuted together, however they are grouped."""
    code = re.match(r"\+\d{1,3}(?=[ .(-])|\+", text)
    head = code[0] if code else ""
    digits = re.sub(r"\D", "", text[len(head):])
    if not 7 <= len(digits) <= 15:
        return None
    new = f"{p.move(int(digits), 10 ** len(digits), f'phone{head}', step):0{len(digits)}d}"
    return head + fill(text[len(head):], new)


KINDS: dict[str, Callable[[Permuter, str, int], str | None]] = {
    "email": email, "iban": iban, "secret": secret, "ymd": ymd, "dmy": dmy, "named": named, "ssn": ssn, "ip": ip, "card": card, "phone": phone}


def shorter(name: str, text: str) -> list[str]:
    """Prefixes of a failed candidate that end where a group does: cards of 13 digits or more, the longest first, and the
    IBAN of its country's length (any length for a country that is not listed)."""
    if name == "card":
        ends = [i for i in range(len(text) - 1, 0, -1) if text[i] in " -"]
        return [text[:i] for i in ends if sum(map(str.isdigit, text[:i])) >= 13]
    if name == "iban":
        size = IBAN_SIZES.get(text[:2])
        ends = [i for i in range(len(text) - 1, 0, -1) if text[i] == " "]
        return [text[:i] for i in ends if size in (None, i - text[:i].count(" "))]
    return []


def replace(text: str, p: Permuter, step: int = 1) -> tuple[str, int]:
    """The text with its values replaced, and their number. `step` -1 turns pseudonyms back into values.

    A card number or IBAN may be followed by a group that the pattern takes for a part of it: where the longest match
    fails its check, its shorter parts are tried, and the search goes on right behind what was accepted. In a candidate
    without a valid part only later cards and IBANs are looked for: its groups are no telephone numbers of their own.
    """
    if not ANY.search(text):
        return text, 0
    out, found, done, at, failed = [], 0, 0, 0, 0
    while m := VALUE.search(text, at):
        name = next(k for k in KINDS if m[k])
        if m.start() < failed and name not in ("card", "iban"):
            at = m.start() + 1
            continue
        value, new = m[name], KINDS[name](p, m[name], step)
        for part in shorter(name, value) if new is None else ():
            new = KINDS[name](p, part, step)
            if new is not None:
                value = part
                break
        if new is None and name == "card" and VALUE_PHONE.fullmatch(value):  # digits in groups may still be a telephone number
            new = phone(p, value, step)
        at = m.start() + len(value)
        if new is not None:
            out += text[done:m.start()], new
            found, done = found + 1, at
        elif name in ("card", "iban"):
            at, failed = m.start() + 1, max(failed, at)  # a value may start inside what failed
    return "".join(out) + text[done:], found


VALUE_PHONE = re.compile(r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}")


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """All rows and columns, values in `text` replaced, and their number as `n_values`.

    Replaced are e-mail addresses (the part before @), IBANs and card numbers with right check digits (which stay
    right), US social security numbers that can be issued, IPv4 addresses, telephone numbers, dates from 1900 to 2099
    and hexadecimal secrets of 32 digits or more. Equal values have equal pseudonyms in all documents, different ones
    different pseudonyms, none stays the same, and who has the key can undo it (but for the
    leading zeros of dates, and for a card or IBAN whose pseudonym happens to pass its check together with a group beside
    it). Numbers that fail their check stay. NULL
    texts stay NULL with 0 values, texts without values stay as they are. An empty table gives no rows. A column of the
    name n_values is replaced.
    """
    docs = docs.drop("n_values")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema)}{', ' if docs.columns else ''}n_values int"

    def run(batches):
        p = Permuter(key)
        for part in slices(batches, text):
            done = [(None, 0) if t is None else replace(t, p) for t in part.column(text).to_pylist()]
            at = part.schema.get_field_index(text)
            part = part.set_column(at, text, pa.array([x for x, _ in done], pa.string()))
            yield part.append_column("n_values", pa.array([n for _, n in done], pa.int32()))
    return docs.mapInArrow(run, schema)
