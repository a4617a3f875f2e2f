"""PII: format-preserving Feistel pseudonyms.

Found values are permuted within their own format by a keyed Feistel network
over mixed radices, so equal values get equal pseudonyms in every document
and whatever their separators, and the key's owner can turn them back:

* payment cards (13 to 19 digits, Luhn valid): the digits before the check
  digit are permuted, the check digit follows;
* IBANs (mod 97 valid): the account digits are permuted, the check digits follow;
* dates (a real day between 1900 and 2099): the day number is permuted
  within that range by cycle walking and written in the same layout;
  (Month-first dates stay month first; one-digit days and months get a zero.)
* IPv4 addresses (octets up to 255), US social security numbers, phone
  numbers (international prefix and punctuation stay), the local part of
  e-mail addresses, cloud access keys, and values of eight or more
  letters, digits and ``_+/-`` given to a name like token, key or password.

Not looked for: numbers with ``00`` for ``+``, dates with the month's name,
passwords with other signs, bearer tokens without a name and a sign before them,
and IPv4 octets with leading zeros. Numbers that fail their validation are left alone; a short number beside a
card, or text after an IBAN of its country's length, hides neither.
"""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import chunks

KINDS = ("email", "ip", "phone", "card", "ssn", "date", "iban", "secret")
ROUNDS = 10
#: Pseudonyms remembered by one worker; the memory starts afresh beyond.
REMEMBERED = 100_000
_DAY0, _DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()


def permute(key: bytes, kind: str, values: list[int], radices: list[int], back: bool = False) -> list[int]:
    """The Feistel network: each round adds a keyed function of one half to the other."""
    half = (len(values) + 1) // 2
    parts = [list(values[:half]), list(values[half:])]
    bases = [radices[:half], radices[half:]]
    tag = f"{kind}/{','.join(map(str, radices))}/".encode()
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        to, of = (parts[r % 2], parts[1 - r % 2])
        base = bases[r % 2]
        seed = tag + bytes([r]) + b",".join(b"%d" % v for v in of)
        stream = b"".join(
            hashlib.blake2b(seed, digest_size=64, key=key, salt=b"%d" % n).digest() for n in range(-(-len(to) // 8))
        )
        for i, b in enumerate(base):
            step = int.from_bytes(stream[8 * i : 8 * i + 8], "big")
            to[i] = (to[i] - step if back else to[i] + step) % b
    return parts[0] + parts[1]


def _digits(key: bytes, kind: str, text: str, back: bool) -> str:
    """text with its digits permuted; everything else stays."""
    got = iter(permute(key, kind, [int(c) for c in text if c.isdigit()], [10] * sum(c.isdigit() for c in text), back))
    return "".join(str(next(got)) if c.isdigit() else c for c in text)


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _letters(key: bytes, kind: str, text: str, back: bool, classes: tuple[str, ...] = _CLASSES) -> str:
    """text with each letter or digit permuted within its class."""
    of = [next((k for k in classes if c in k), None) for c in text]
    own = [(c, k) for c, k in zip(text, of, strict=True) if k]
    got = iter(permute(key, kind, [k.index(c) for c, k in own], [len(k) for _, k in own], back))
    return "".join(k[next(got)] if k else c for c, k in zip(text, of, strict=True))


def luhn_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


_GROUP = re.compile(r"\d+")
_SHAPES = ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4])


def _windows(text: str) -> list[tuple[tuple, int, int]]:
    """(order, start, end) of what may be a card among groups of digits with single separators, by the layout alone.

    Tried first are single groups, then the usual groupings, then what begins
    the text, then other groups of four or more digits; longer ones first.
    """
    groups = [m.span() for m in _GROUP.finditer(text)]
    sizes = [b - a for a, b in groups]
    out = []
    for i in range(len(groups)):
        n = 0
        for j in range(i, len(groups)):
            n += sizes[j]
            if n > 19:
                break
            own = sizes[i : j + 1]
            rank = 0 if i == j else 1 if own in _SHAPES else 2 if i == 0 else 3
            if n >= 13 and (rank < 3 or min(own) >= 4):
                out.append(((rank, -n, i), groups[i][0], groups[j][1]))
    return sorted(out)


def _is_card(text: str) -> bool:
    digits = re.sub(r"\D", "", text)
    return luhn_digit(digits[:-1]) == digits[-1] and bool(digits.strip(digits[0]))


def _chosen(text: str, windows: list) -> list[tuple[tuple, int, int]]:
    """The valid windows, taken in order, without overlaps; by place."""
    used, out = bytearray(len(text)), []
    for w in windows:
        if not any(used[w[1] : w[2]]) and _is_card(text[w[1] : w[2]]):
            used[w[1] : w[2]] = b"1" * (w[2] - w[1])
            out.append(w)
    return sorted(out, key=lambda w: w[1])


def cards(text: str) -> list[tuple[int, int]]:
    """Spans of the valid card numbers among groups of digits."""
    return [w[1:] for w in _chosen(text, _windows(text))]


def _card(key: bytes, text: str, back: bool) -> str | None:
    """All cards of the text.

    Each is walked until the windows that go before it and overlap it are as
    valid as they were, so that the same places read as cards and turn back.
    """
    windows = _windows(text)
    chosen = _chosen(text, windows)
    if not chosen:
        return None
    ends = sorted(windows, key=lambda w: w[1])
    starts = [w[1] for w in ends]
    for own in reversed(chosen) if back else chosen:
        _, a, b = own
        near = ends[bisect.bisect_left(starts, a - 40) : bisect.bisect_left(starts, b)]  # a window has 37 characters at most
        rivals = [w for w in near if w[2] > a and w <= own]
        before = [_is_card(text[c:d]) for _, c, d in rivals]
        while True:
            new = _digits(key, "card", re.sub(r"\D", "", text[a:b])[:-1], back)
            got = iter(new + luhn_digit(new))
            text = text[:a] + "".join(next(got) if c.isdigit() else c for c in text[a:b]) + text[b:]
            if [_is_card(text[c:d]) for _, c, d in rivals] == before:
                break
    return text


def _ssn(key: bytes, text: str, back: bool) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    n = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
    n = _walk(key, "ssn", n, 898 * 99 * 9999, back)
    n, serial = divmod(n, 9999)
    area, group = divmod(n, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _walk(key: bytes, kind: str, n: int, size: int, back: bool) -> int:
    """A permutation of range(size): over the next power of two, walked until inside."""
    bits = (size - 1).bit_length()
    while True:
        got = permute(key, kind, [n >> k & 1 for k in range(bits)], [2] * bits, back)
        n = sum(b << k for k, b in enumerate(got))
        if n < size:
            return n


def _date(key: bytes, text: str, back: bool) -> str | None:
    sep = re.search(r"\D", text)[0]
    parts = text.split(sep)
    year_first = len(parts[0]) == 4
    # Day first unless only month first is a real day.
    for order in (("ymd",) if year_first else ("dmy", "mdy")):
        named = dict(zip(order, parts, strict=True))
        try:
            day = dt.date(int(named["y"]), int(named["m"]), int(named["d"])).toordinal() - _DAY0
        except ValueError:
            continue
        if 0 <= day < _DAYS:
            day = _walk(key, "date", day, _DAYS, back)
            while order == "mdy" and dt.date.fromordinal(_DAY0 + day).day <= 12:  # must not read as day first
                day = _walk(key, "date", day, _DAYS, back)
            new = dt.date.fromordinal(_DAY0 + day)
            return sep.join({"y": f"{new.year}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}[c] for c in order)
    return None


def _ip(key: bytes, text: str, back: bool) -> str | None:
    octets = text.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in octets):
        return None
    return ".".join(map(str, permute(key, "ip", [int(x) for x in octets], [256] * 4, back)))


# International calling codes of one and two digits; all others have three.
_ONE_DIGIT_CODES = frozenset("17")
_TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)


def _phone(key: bytes, text: str, back: bool) -> str | None:
    """The calling code stays, by the table of codes, so that separators don't decide where it ends."""
    cut = 0
    if text[0] == "+":
        cut = 2 if text[1] in _ONE_DIGIT_CODES else 3 if text[1:3] in _TWO_DIGIT_CODES else 4
        if not text[1:cut].isdigit():
            return None
    if not 7 <= sum(c.isdigit() for c in text[cut:]) <= 12:
        return None
    return text[:cut] + _digits(key, "phone", text[cut:], back)


#: Characters of an IBAN by country.
IBAN_LENGTH = {
    c: int(n)
    for n, codes in (x.split(":") for x in (
        "15:NO 16:BE 18:DK-FI-FO-GL-NL 19:MK-SI 20:AT-BA-EE-KZ-LT-LU-XK 21:CH-HR-LI-LV 22:BG-BH-CR-DE-GB-GE-IE-ME-RS-VA "
        "23:AE-GI-IL-IQ-TL 24:AD-CZ-ES-MD-PK-RO-SA-SE-SK-TN-VG 25:LY-PT-ST 26:IS-TR 27:FR-GR-IT-MC-MR-SM 28:AL-AZ-BY-CY-DO-GT-HU-LB-PL-SV "
        "29:BR-EG-PS-QA-UA 30:JO-KW-MU 31:MT-SC 32:LC"
    ).split())
    for c in codes.split("-")
}


def _iban_end(text: str) -> int:
    """Where an IBAN of its country's length ends in the text; the whole text if none does."""
    ends = [k + 1 for k, c in enumerate(text) if c != " "]
    n = IBAN_LENGTH.get(text[:2], len(ends))
    return ends[n - 1] if n <= len(ends) and not text[ends[n - 1] : ends[n - 1] + 1].isalnum() else len(text)


def _iban(key: bytes, text: str, back: bool) -> str | None:
    flat = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(flat) <= 34 or number(flat[4:] + flat[:4]) % 97 != 1 or not 2 <= int(flat[2:4]) <= 98:
        return None
    body = _letters(key, "iban", flat[4:], back)
    check = 98 - number(body + flat[:2] + "00") % 97
    got = iter(f"{flat[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(got) for c in text)


def _email(key: bytes, text: str, back: bool) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{_letters(key, 'email', local, back)}@{domain}" if local.strip(".") else None


_ACCESS_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?!\w)")


def _shape(text: str) -> str:
    """What a secret reads as: lower-case hexadecimal, an access key, or other."""
    return "hex" if re.fullmatch(r"[0-9a-f]+", text) else "access" if _ACCESS_KEY.match(text) else "other"


def _secret(key: bytes, text: str, back: bool) -> str | None:
    """Lower-case hexadecimal values permute as one class, access keys after their
    mark; all others are walked until they read as neither."""
    shape = _shape(text)
    if shape == "hex":
        return _letters(key, "secret", text, back, ("0123456789abcdef",))
    if shape == "access":
        return text[:4] + _letters(key, "secret", text[4:20], back, ("0123456789" + _CLASSES[2],)) + text[20:]
    while True:
        text = _letters(key, "secret", text, back)
        if _shape(text) == shape:
            return text


_CHANGE: dict[str, Callable[[bytes, str, bool], str | None]] = {
    "email": _email, "ip": _ip, "phone": _phone, "card": _card, "ssn": _ssn, "date": _date, "iban": _iban, "secret": _secret,
}

_HEAD = re.compile(r"\d+")
# Tried at the start of a run of digits (or the "+" or "(" before it).
_NUMBER = re.compile(
    r"(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)"
    r"|(?P<date>\d{4}([-/.])\d{1,2}\3\d{1,2}|\d{1,2}([-/.])\d{1,2}\4\d{4})(?!(?!T\d)\w|[-/.]\d)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w]|[-.]\d)"
)
# Groups of digits that may hold cards.
_RUN = re.compile(r"\d+(?:[ -]\d+)*(?!\w|\.\d)")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_SECRET = re.compile(r"[=:]\s?([\"']?)([A-Za-z0-9_+/-]{8,})\1(?![\w])")
_NAMED = re.compile(r"(?i)token|key|secret|password|passwd|pwd|auth|credential")


def _name(text: str, end: int) -> str:
    """The whole name, quoted or not, before the sign at ``end``."""
    if end and text[end - 1].isspace():
        end -= 1
    if end and text[end - 1] in "\"'":
        end -= 1
    begin = end
    while begin and (text[begin - 1].isalnum() or text[begin - 1] == "_"):
        begin -= 1
    return text[begin:end]


def _free(text: str, begin: int) -> bool:
    """Whether a number may begin here."""
    return not begin or not (text[begin - 1].isalnum() or text[begin - 1] in "_.-") or text[begin - 1] == "." and not text[begin - 2 : begin - 1].isdigit()


def _run_end(text: str, start: int, limit: int) -> int:
    """End of the groups of digits from start on that may hold cards: before any other kind, which keeps its own digits."""
    run = _RUN.match(text, start)
    if not run:
        return start
    stop = run.end()
    for m in _GROUP.finditer(text, start, stop):
        other = m.start() > start and text[m.start() - 1] == " " and _NUMBER.match(text, m.start())
        if other or m.end() > limit:
            return max(start, m.start() - 1)
    return stop


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the candidates in a text, without overlaps, in order."""
    spans: list[tuple[int, int, str]] = []
    for m in _ACCESS_KEY.finditer(text):
        if not text[m.start() - 1 : m.start()].isalnum():
            spans.append((m.start(), m.end(), "secret"))
    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            if _NAMED.search(_name(text, m.start())):
                spans.append((m.start(2), m.end(2), "secret"))
    at = text.find("@")
    while at >= 0:
        domain, begin = _DOMAIN.match(text, at), at
        while domain and begin and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at:
            spans.append((begin, domain.end(), "email"))
        at = text.find("@", at + 1)
    taken = sorted(spans)
    end, k = 0, 0
    for m in _HEAD.finditer(text):
        start = m.start()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if start < end or k < len(taken) and taken[k][0] <= start:
            continue
        got = None
        if start >= 2 and text[start - 2 : start].isalpha() and not text[start - 3 : start - 2].isalnum():
            got = _IBAN.match(text, start - 2)
            if got:
                stop = got.start() + _iban_end(got[0])
                if _iban(b"", text[got.start() : stop], False):
                    spans.append((got.start(), stop, "iban"))
                    end = stop
                    continue
            got = None
        for back in (1, 0):
            if back and text[start - 1 : start] not in ("+", "("):
                continue
            begin = start - back
            if _free(text, begin):
                got = _NUMBER.match(text, begin)
                if got:
                    break
            if not back and _free(text, start):
                stop = _run_end(text, start, taken[k][0] if k < len(taken) else len(text))
                if cards(text[start:stop]):
                    spans.append((start, stop, "card"))
                end = stop
        if got:
            spans.append((got.start(), got.end(), got.lastgroup))
            end = got.end()
    return sorted(spans)


def rewrite(text: str, key: bytes, memory: dict, back: bool = False) -> tuple[str, list[int]]:
    """The text with pseudonyms (back: with the values again), and how many of each kind."""
    counts, out, at = [0] * len(KINDS), [], 0
    for start, end, kind in find(text):
        if start < at:
            continue
        value = text[start:end]
        slot = (kind, value)
        if slot not in memory:
            if len(memory) >= REMEMBERED:
                memory.clear()
            memory[slot] = _CHANGE[kind](key, value, back)
        new = memory[slot]
        if new is None:
            continue
        counts[KINDS.index(kind)] += len(cards(value)) if kind == "card" else 1
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]) if out else text, counts


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """(id_col, text, n_<kind>...) of every row, the text with pseudonyms.

    ``key`` is the secret of the permutation; ``back`` undoes it. A null
    text stays null and has no value; empty texts, null ids and repeated
    rows give their rows; other columns are not read.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            for part, texts in chunks(batch):
                got = [(None, [0] * len(KINDS)) if t is None else rewrite(t, secret, memory, back) for t in texts]
                counts = list(zip(*(c for _, c in got), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([t for t, _ in got], pa.string()), *[pa.array(c, pa.int64()) for c in counts]],
                    names=["id", "text", *[f"n_{k}" for k in KINDS]],
                )

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = base.mapInArrow(run, "id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))
    return out.withColumnRenamed("id", id_col)
