"""Personal data replaced by surrogates: keyed, of the same kind and form, distinct, and the same everywhere.

E-mail addresses, phone, card and social-security numbers, IP addresses, bank accounts (IBAN) and
names after a title, with further mentions of the same names in that text, are found. One full name is one
person: a title that tells no gender takes that of another mention, in whatever document. A surrogate is a keyed permutation of the values of the
same form (Feistel rounds over a keyed hash), so two different values never get one surrogate by the
permutation itself: digits stay digits, letters letters of their case and of their own script, check digits are made to
fit, a title keeps its gender. One value has one surrogate in all documents, whatever the marks it
is written with. Surrogates that are themselves values of the corpus, and those that two values share
(only names can), are found by joins and drawn anew until none is left.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import slices
from oreflow.session import staged

#: Redrawn values sent to all executors; beyond that they are joined to their documents.
SMALL_REDRAWN = 50_000
#: From this draw on a surrogate may grow, for forms of which all values are taken.
GROWING_DRAW = 12

#: Given names by gender and script, in the order of the alphabet.
GIVEN = {
    ("f", "latin"): "Alice Anna Clara Diana Elena Emma Eva Grace Helen Ines Julia Laura Lucia Maria Nina Olga Paula Rosa Sara Vera".split(),
    ("m", "latin"): "Adam Albert Bruno Carlos Daniel David Erik Felix George Hugo Ivan James Karl Leon Martin Oscar Peter Robert Simon Victor".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Софья Татьяна".split(),
    ("m", "cyrillic"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
    ("f", "greek"): "Άννα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("m", "greek"): "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
}
#: Titles by the gender they tell.
TITLES = {
    "f": "Mrs Ms Miss Madame Mme Mlle Frau Señora Sra Госпожа Κυρία".split(),
    "m": "Mr Mister Monsieur Herr Señor Sr Господин Κύριος".split(),
    "n": "Dr Prof".split(),
}
#: Syllables that made-up names consist of, by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke la le li lo ma me mi mo na ne no ra re ri ro sa se so ta te to va ve vi za zo".split(),
    "cyrillic": "ба бо ва ве го да де до за ка ко ла ле ли ма ме на но па ра ро са та то".split(),
    "greek": "βα γε δα δη θε κα κο λα λε μα μη να νι πα πο ρα ρο σα τα το".split(),
}
_GENDER = {t: g for g, names in TITLES.items() for t in names}
_KNOWN = {n.lower(): g for (g, _), names in GIVEN.items() for n in names}
# A possessive ending is no part of a name.
_NAME = r"[^\W\d_]+(?:-[^\W\d_]+|['’](?![sS](?!\w))[^\W\d_]+)*"
_WORD = re.compile(rf"(?<!\w){_NAME}(?!\w)")
_CAPITALS = "".join(c for c in map(chr, range(0x110000)) if c.isupper())

_LOCAL_START = r"(?<![\w.+-])[A-Za-z0-9]"
_LOCAL = r"[A-Za-z0-9._%+-]"
_HOST = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])"
EMAIL = f"{_LOCAL_START}{_LOCAL}*{_HOST}"
IP = r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w)"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = (
    r"(?<![\w+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
    r"|\+(?!1\D)\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\.\d))(?![\w-])"
)
CARD = r"(?<![\w+.-])\d(?:[ -]?\d){12,18}(?![\w-])"
_TITLE = "(?:" + "|".join(sorted(_GENDER, key=len, reverse=True)) + r")\.?[ \u00A0]"
# Words with a capital, up to the next title.
PERSON = rf"(?<!\w)(?:{_TITLE}){{1,3}}(?P<names>(?=[{_CAPITALS}]){_NAME}(?:[ \u00A0](?!{_TITLE})(?=[{_CAPITALS}]){_NAME})*)"
_OTHERS = f"(?P<iban>{IBAN})|(?P<ssn>{SSN})|(?P<ip>{IP})|(?P<phone>{PHONE})|(?P<card>{CARD})|(?P<person>{PERSON})"
#: All that is found. Texts are searched with e-mail addresses apart (`_found`): here each `%` starts a scan of its own.
FOUND = re.compile(f"(?P<email>{EMAIL})|{_OTHERS}")
_NOT_EMAIL = re.compile(_OTHERS)
_LOCAL_RUN, _START, _HOST_AT = re.compile(f"{_LOCAL}+"), re.compile(_LOCAL_START), re.compile(_HOST)
#: Texts without any of these have nothing to replace: each alternative of FOUND needs one of them.
_ANY = r"@|\p{Nd}{3}|\p{Nd}\.\p{Nd}+\.|\+\p{Nd}|[A-Z]{2}\p{Nd}{2} ?[A-Z0-9]{4}|(?:\p{Nd}[ -]?){12}\p{Nd}|" + "|".join(f"{t}\\.?[ \u00A0]" for t in _GENDER)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _iban_checks(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def script_of(word: str) -> str:
    """The script of the first letter: the first word of its name."""
    return unicodedata.name(word[0], "").partition(" ")[0].lower()


def _group(letter: str) -> str:
    """Script and sort of a small letter, by its name; those without one capital are apart."""
    plain = len(letter.upper()) == 1 and letter.upper() != letter
    return " ".join(unicodedata.name(letter, "").split(" ")[:2]) + (" *" if not plain else "")


@functools.cache
def _alphabets() -> dict[str, str]:
    """Small letters, and letters without case, by group."""
    letters: dict[str, list[str]] = {}
    for c in map(chr, range(0x110000)):
        if c.isalpha() and c == c.lower():
            letters.setdefault(_group(c), []).append(c)
    return {group: "".join(own) for group, own in letters.items()}


class Keyed:
    """Keyed permutations. `tweak` separates forms and draws."""

    def __init__(self, key: bytes):
        self.key = key

    def number(self, *parts: object) -> int:
        raw = "\x1f".join(map(str, parts)).encode()
        return int.from_bytes(hashlib.blake2b(raw, key=self.key, digest_size=16).digest(), "big")

    def permute(self, value: int, a: int, b: int, tweak: str) -> int:
        """A permutation of 0 .. a * b - 1 by Feistel rounds."""
        left, right = divmod(value, b)
        for k in range(0, 10, 2):
            left = (left + self.number(tweak, k, right)) % a
            right = (right + self.number(tweak, k + 1, left)) % b
        return left * b + right

    def text(self, value: str, alphabet: str, tweak: str) -> str:
        """A permutation of the words of one length over an alphabet."""
        n, base = len(value), len(alphabet)
        if not n:
            return value
        number = 0
        for c in value:
            number = number * base + alphabet.index(c)
        number = self.permute(number, base ** (n - n // 2), base ** (n // 2), f"{tweak}/{n}")
        out = []
        for _ in range(n):
            number, d = divmod(number, base)
            out.append(alphabet[d])
        return "".join(reversed(out))

    def shaped(self, value: str, tweak: str) -> str:
        """Lower-case letters and digits permuted in their places; other characters stay."""
        letters = "".join(c for c in value if "a" <= c <= "z")
        digits = "".join(c for c in value if "0" <= c <= "9")
        shape = "".join("a" if "a" <= c <= "z" else "9" if "0" <= c <= "9" else c for c in value)
        letters = self.text(letters, "abcdefghijklmnopqrstuvwxyz", f"{tweak}|{shape}")
        digits = self.text(digits, "0123456789", f"{tweak}|{shape}|{letters}")
        a, b = iter(letters), iter(digits)
        return "".join(next(a) if c == "a" else next(b) if c == "9" else c for c in shape)

    def letters(self, value: str, tweak: str) -> str:
        """Small letters permuted in their places, those of each script among themselves; other characters stay."""
        scripts = [_group(c) if c.isalpha() and c == c.lower() else "" for c in value]
        rest = {}
        for script in sorted(set(scripts) - {""}):
            own = "".join(c for c, x in zip(value, scripts, strict=True) if x == script)
            rest[script] = iter(self.text(own, _alphabets()[script], f"{tweak}|{','.join(scripts)}"))
        return "".join(next(rest[x]) if x else c for c, x in zip(value, scripts, strict=True))

    def digits_where(self, value: str, tweak: str, fits) -> str:
        """Digits permuted among those that fit, by walking the cycle; it comes back to the value, which fits."""
        out = self.text(value, "0123456789", tweak)
        while not fits(out):
            out = self.text(out, "0123456789", tweak)
        return out


def canonical(kind: str, text: str) -> str:
    """What makes two spellings one value; digits of all scripts count as their ASCII ones."""
    if not text.isascii():
        text = "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)
    if kind == "email":
        return text.lower()
    if kind == "iban":
        return text.replace(" ", "")
    if kind in ("phone", "card", "ssn"):
        digits = re.sub(r"\D", "", text)
        return digits[1:] if kind == "phone" and len(digits) == 11 and digits[0] == "1" else digits
    return text if kind == "ip" else text.lower()


def surrogate(kind: str, value: str, draw: int, keyed: Keyed) -> str:
    """The surrogate of a canonical value, in canonical form. Each draw is another permutation."""
    tweak = f"{kind}#{draw}"
    more = keyed.text(str(draw).rjust(4, "0"), "0123456789", tweak) if draw >= GROWING_DRAW else ""
    if kind == "email":
        local, _, host = value.rpartition("@")
        name, _, top = host.rpartition(".")
        return f"{keyed.shaped(local, tweak + 'l')}{more}@{keyed.shaped(name, tweak + 'h')}.{top}"
    if kind == "ip":
        a, b, c, d = map(int, value.split("."))
        if (a, b) == (192, 168) or (a == 172 and 16 <= b < 32):
            x = keyed.permute(c * 256 + d, 256, 256, f"{tweak}/{a}.{b}")
            return f"{a}.{b}.{x >> 8}.{x & 255}"
        if a in (0, 10, 127) or a >= 224:
            x = keyed.permute((b << 16) + (c << 8) + d, 4096, 4096, f"{tweak}/{a}")
            return f"{a}.{x >> 16}.{x >> 8 & 255}.{x & 255}"
        x = (a << 24) + (b << 16) + (c << 8) + d
        while True:
            x = keyed.permute(x, 65536, 65536, tweak)
            a, b = x >> 24, x >> 16 & 255
            if a not in (0, 10, 127) and a < 224 and (a, b) != (192, 168) and not (a == 172 and 16 <= b < 32):
                return f"{a}.{b}.{x >> 8 & 255}.{x & 255}"
    if kind == "ssn":
        fits = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        return keyed.digits_where(value, tweak, fits) if fits(value) else keyed.text(value, "0123456789", tweak + "odd")
    if kind == "card":
        if _luhn(value):
            body = value[0] + keyed.text(value[1:-1], "0123456789", f"{tweak}/{value[0]}")
            return next(body + c for c in "0123456789" if _luhn(body + c))
        return value[0] + keyed.digits_where(value[1:], f"{tweak}/{value[0]}-", lambda d: not _luhn(value[0] + d))
    if kind == "phone":
        if len(value) == 10 and value[3:6] == "555":  # a made-up exchange stays one
            out = keyed.digits_where(value[:3] + value[6:], tweak + "555", lambda d: d[0] > "1" or value[0] <= "1")
            return out[:3] + "555" + out[3:] + more
        if len(value) == 10:
            return keyed.digits_where(value, tweak, lambda d: (d[0] > "1" and d[3] > "1" and d[3:6] != "555") or value[0] <= "1" or value[3] <= "1") + more
        return value[:2] + keyed.text(value[2:], "0123456789", f"{tweak}/{value[:2]}") + more
    if kind == "iban":
        rest = keyed.shaped(value[4:].lower(), f"{tweak}/{value[:2]}").upper()
        return value[:2] + _iban_checks(value[:2], rest) + rest
    role, gender = kind.split("_")
    script = script_of(value)
    listed = [n.lower() for n in GIVEN.get((gender, script), [])]
    if role == "given" and value in listed and not draw:
        order = sorted(range(len(listed)), key=lambda k: keyed.number(kind, script, k))
        at = listed.index(value)
        return listed[order[(order.index(at) + 1) % len(order)]]
    if script not in SYLLABLES:
        alphabet = _alphabets().get(_group(value[0]), "")
        grown = [alphabet[keyed.number(tweak, value, k) % len(alphabet)] for k in range(max(0, draw + 1 - GROWING_DRAW))] if alphabet else []
        return keyed.letters(value, tweak) + "".join(grown)
    syllables = SYLLABLES[script]
    x = keyed.number(tweak, value)
    count = 2 if role == "given" else 4
    parts = [syllables[x // len(syllables) ** k % len(syllables)] for k in range(count + draw // 3)]
    ends = {("latin", "f"): "na", ("latin", "m"): "n", ("cyrillic", "f"): "на", ("cyrillic", "m"): "н", ("greek", "f"): "να", ("greek", "m"): "ς"}
    return "".join(parts) + (ends.get((script, gender), "") if role == "given" else "")


def rendered(kind: str, original: str, value: str) -> str:
    """A canonical surrogate written the way the original is, in its script of digits."""
    foreign = next((c for c in original if c.isdecimal() and c > "9"), None)
    if foreign:
        plain = "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in original)
        zero = ord(foreign) - unicodedata.decimal(foreign)
        return "".join(chr(zero + int(c)) if "0" <= c <= "9" else c for c in rendered(kind, plain, value))
    if kind in ("ip",):
        return value
    if kind == "phone" and len(re.sub(r"\D", "", original)) == 11 and len(canonical(kind, original)) == 10:
        at = re.search(r"1", original).end()
        return original[:at] + rendered("digits", original[at:], value)
    if kind in ("phone", "card", "ssn", "digits", "iban"):
        rest = iter(value)
        out = "".join(next(rest, "") if c.isalnum() else c for c in original)
        return out + "".join(rest)
    if kind == "email":
        if original.isupper():
            return value.upper()
        return "".join(v.upper() if k < len(original) and original[k].isupper() else v for k, v in enumerate(value))
    if original.isupper() and len(original) > 1:
        return value.upper()
    return value[0].upper() + value[1:] if original[0].isupper() else value


def _mentions(text: str, taken: list[tuple[int, int, str]], persons: list[list[tuple[str, str]]]) -> Iterator[tuple[int, int, str]]:
    """Further mentions of persons, whole or in part, outside of what is taken; a person is a list of (name, kind)."""
    whole: dict[str, list[tuple[tuple[str, ...], list[str]]]] = {}
    alone: dict[str, str] = {}
    for person in sorted(persons, key=len, reverse=True):
        names = tuple(n for n, _ in person)
        if len(names) > 1:
            whole.setdefault(names[0], []).append((names, [k for _, k in person]))
        for name, kind in person:
            alone.setdefault(name, kind)
    edges = [0, *(x for a, b, _ in taken for x in (a, b)), len(text)]
    for lo, hi in zip(edges[::2], edges[1::2], strict=True):
        words = [w for w in _WORD.finditer(text, lo, hi) if w[0][0].isupper() or not w[0].isalpha()]
        k = 0
        while k < len(words):
            w = words[k]
            for names, kinds in whole.get(w[0].lower(), ()):
                own = words[k : k + len(names)]
                if w[0][0].isupper() and tuple(x[0].lower() for x in own) == names and all(text[x.end() : y.start()].isspace() for x, y in zip(own, own[1:], strict=False)):
                    yield from ((x.start(), x.end(), kind) for x, kind in zip(own, kinds, strict=True))
                    k += len(names)
                    break
            else:
                k += 1
                if w[0][0].isupper() and w[0].lower() in alone:
                    yield w.start(), w.end(), alone[w[0].lower()]
                else:  # of a compound, the parts that are names
                    for x in re.finditer(r"[^\W\d_]+", w[0]):
                        if x[0][0].isupper() and x[0].lower() in alone:
                            yield w.start() + x.start(), w.start() + x.end(), alone[x[0].lower()]


def _found(text: str) -> Iterator[tuple[int, int, str, re.Match | None]]:
    """Start, end, kind and, but for e-mail addresses, match of what FOUND finds, in time that grows with the text.

    Addresses are searched from their `@` on: characters that may stand before it are looked at once.
    """
    emails = []
    if "@" in text:
        for run in _LOCAL_RUN.finditer(text):
            host = _HOST_AT.match(text, run.end())
            if host:
                emails.append((run.start(), run.end(), host.end()))
    at, k, other = 0, 0, _NOT_EMAIL.search(text)
    while True:
        start = None
        while k < len(emails) and start is None:
            first = _START.search(text, max(at, emails[k][0]), emails[k][1]) if at < emails[k][1] else None
            if first is None:
                k += 1
            else:
                start = first.start()
        if start is not None and (other is None or start <= other.start()):
            at = emails[k][2]
            yield start, at, "email", None
        elif other is not None:
            at = other.end()
            yield other.start(), at, other.lastgroup if other.lastgroup != "names" else "person", other
        else:
            return
        if other is not None and other.start() < at:
            other = _NOT_EMAIL.search(text, at)


def entities(text: str, told: Callable[[str], str | None] = lambda name: None, full: dict | None = None) -> list[tuple[int, int, str]]:
    """Start, end and kind of what is to be replaced, in order.

    A person named after a title is found again without it, by full name or by any of the names, if
    written with a capital. A title that tells no gender takes that of another mention of the full name
    in the text, or else what `told` says of it. `full` is filled with the full names
    (in small letters, with blanks) by gender that titles tell, and with those, under "n", of which the text tells none.
    """
    out, people = [], []
    for start, end, kind, m in _found(text):
        if kind == "card" and len(re.sub(r"\D", "", m[0])) < 13:
            continue
        if kind != "person":
            out.append((start, end, kind))
            continue
        at = m.start("names")
        titles = [_GENDER[w] for w in re.findall(r"\w+", text[m.start() : at])]
        names = [(at + w.start(), at + w.end(), w[0]) for w in re.finditer(r"\S+", m["names"])]
        people.append((next((g for g in titles if g != "n"), "n"), names))
    if not people:
        return out
    genders = {}
    for gender, names in people:
        if gender != "n":
            genders.setdefault(tuple(n.lower() for *_, n in names), gender)
    persons = []
    for gender, names in people:
        whole = tuple(n.lower() for *_, n in names)
        gender = gender if gender != "n" else genders.get(whole, "n")
        if full is not None:
            full.setdefault(gender, set()).add(" ".join(whole))
        if gender == "n":
            gender = told(" ".join(whole)) or "n"
        person = []
        for k, (a, b, name) in enumerate(names):
            given = k < len(names) - 1 or name.lower() in _KNOWN
            own = gender if gender != "n" else _KNOWN.get(name.lower(), "n")
            person.append((name.lower(), f"given_{own}" if given else "family_n"))
            out.append((a, b, person[-1][1]))
        persons.append(person)
    out.sort()
    return sorted([*out, *_mentions(text, out, persons)])


#: Kinds of the rows that hold full names, by gender; in the order of the alphabet what is told comes first.
_TOLD = {"f": "told_f", "m": "told_m", "n": "untold"}
_GENDERS = {1: "f", 2: "m"}


def _may(texts: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring_regex(texts.fill_null(""), _ANY).to_numpy(zero_copy_only=False))


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kinds and values; also full names by the gender that titles tell (told_f, told_m) or do not (untold)."""
    for batch in (part for whole in batches for part in slices(whole, 0, 4 << 20)):
        texts, found = batch.column(0), set()
        for k in _may(texts):
            text, full = texts[int(k)].as_py(), {}
            found.update((kind, canonical(kind, text[a:b])) for a, b, kind in entities(text, full=full))
            found.update((_TOLD[gender], name) for gender, names in full.items() for name in names)
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.string()) for i in (0, 1)], names=["kind", "value"])


def _draw(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    keyed = Keyed(key)
    for batch in batches:
        kinds, values, draws = (c.to_pylist() for c in batch.columns)
        made = [surrogate(k, v, d, keyed) for k, v, d in zip(kinds, values, draws, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "value", "draw", "surrogate"])


def redrawn(texts: DataFrame, key: bytes) -> DataFrame:
    """kind, value and draw (from 1) of the values whose first surrogate was taken, and the genders of persons.

    Taken: it is a value of the corpus itself, or another value has it, a smaller one or one of an
    earlier draw. All names, given or not, are in one space. Values are counted once each,
    combined before their shuffle. Rounds go on until no value is left to draw for. Rows of the kind `told` say
    of a full name that some title tells no gender of, but another title anywhere does, which it is:
    draw 1 for f, also where both are told, and 2 for m.
    """
    pair = T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])
    made = T.StructType([*pair.fields, T.StructField("draw", T.IntegerType()), T.StructField("surrogate", T.StringType())])
    found = staged(texts.mapInArrow(_values, pair).distinct(), "entities")
    told = found.where(F.col("kind").isin(*_TOLD.values())).groupBy("value").agg(F.min("kind").alias("least"), F.max("kind").alias("most"))
    told = told.where(F.col("most") == _TOLD["n"]).where(F.col("least") != _TOLD["n"])
    told = told.select(F.lit("told").alias("kind"), "value", F.when(F.col("least") == _TOLD["f"], 1).otherwise(2).alias("draw"))
    values = found.where(~F.col("kind").isin(*_TOLD.values()))
    table = values.select("kind", "value", F.lit(0).alias("draw"))
    space = F.when(F.col("kind").rlike("^(given|family)_"), "name").otherwise(F.col("kind"))
    real = values.select(space.alias("space"), F.col("value").alias("surrogate"), F.lit(True).alias("real")).distinct()
    while True:
        drawn = staged(table.mapInArrow(partial(_draw, key=key), made), "surrogates")
        first = Window.partitionBy("space", "surrogate").orderBy("draw", "value", "kind")
        checked = drawn.withColumn("space", space).join(real, ["space", "surrogate"], "left").withColumn("place", F.row_number().over(first))
        taken = (F.col("place") > 1) | F.col("real").isNotNull()
        table = staged(checked.select("kind", "value", (F.col("draw") + taken.cast("int")).alias("draw"), taken.alias("taken")), "draws")
        if table.where("taken").isEmpty():
            return table.where("draw > 0").select("kind", "value", "draw").unionByName(told)
        table = table.select("kind", "value", "draw")


def _replace(batches: Iterator[pa.RecordBatch], key: bytes, text_at: int, few, drawn_at: int | None, keep: list[int], count: str) -> Iterator[pa.RecordBatch]:
    keyed, known = Keyed(key), {}
    for batch in (part for whole in batches for part in slices(whole, text_at, 4 << 20)):
        texts = batch.column(text_at)
        may, counts, values = _may(texts), np.zeros(len(texts), np.int64), None
        for k in may.tolist():
            text = texts[k].as_py()
            draws = few.value if drawn_at is None else {(x["kind"], x["value"]): x["draw"] for x in batch.column(drawn_at)[k].as_py() or ()}
            found = entities(text, lambda name, draws=draws: _GENDERS.get(draws.get(("told", name))))
            if not found:
                continue
            out, at = [], 0
            for a, b, kind in found:
                value = canonical(kind, text[a:b])
                draw = draws.get((kind, value), 0)
                made = known.get((kind, value, draw))
                if made is None:
                    if len(known) > 50_000:
                        known.clear()
                    made = known[kind, value, draw] = surrogate(kind, value, draw, keyed)
                out += [text[at:a], rendered(kind, text[a:b], made)]
                at = b
            values = texts.to_pylist() if values is None else values
            values[k] = "".join([*out, text[at:]])
            counts[k] = len(found)
        columns = [batch.column(i) if i != text_at or values is None else pa.array(values, texts.type) for i in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], names=[*(batch.schema.names[i] for i in keep), count])


def _values_by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What may be asked for a text: its values, its persons without a gender, and their names as of either."""
    for batch in (part for whole in batches for part in slices(whole, 1, 4 << 20)):
        texts, found = batch.column(1), set()
        for k in _may(texts):
            mark, text, full = batch.column(0)[int(k)].as_py(), texts[int(k)].as_py(), {}
            found.update((mark, kind, canonical(kind, text[a:b])) for a, b, kind in entities(text, full=full))
            for name in full.get("n", ()):
                found.add((mark, "told", name))
                found.update((mark, f"given_{gender}", part) for gender in "fm" for part in name.split(" "))
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))], names=["print", "kind", "value"])


def replace_entities(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """The documents with personal data in their texts replaced; all other columns and rows stay as they are.

    `key` decides the surrogates: the same key gives the same ones. `count_col`, a name that the documents
    do not have, adds the number of places replaced. Null and empty texts stay; repeated rows get equal texts. Of values
    that draw one surrogate the one of the earlier draw keeps it, then the smaller. Texts are read whole, in time that
    grows with their length.
    """
    names = docs.columns
    if count_col in names:
        raise ValueError(f"the documents have a column {count_col} already")
    drawn = staged(redrawn(docs.select(F.col(f"`{text_col}`").alias("text")), key), "drawn")
    n = drawn.count()
    rows, few, drawn_at = docs, None, None
    if n <= SMALL_REDRAWN:
        few = docs.sparkSession.sparkContext.broadcast({(r.kind, r.value): r.draw for r in drawn.collect()})
    else:
        mark, list_of = _free_name(names, "print"), _free_name(names, "drawn")
        text = F.col(f"`{text_col}`")
        schema = T.StructType([T.StructField("print", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])
        prints = docs.select(F.xxhash64(text).alias("print"), text.alias("text")).mapInArrow(_values_by_text, schema)
        by_text = prints.distinct().join(drawn, ["kind", "value"]).groupBy(F.col("print").alias(mark)).agg(F.collect_list(F.struct("kind", "value", "draw")).alias(list_of))
        rows = docs.withColumn(mark, F.xxhash64(text)).join(by_text, mark, "left").select(*[F.col(f"`{c}`") for c in names], list_of)
        drawn_at = len(names)
    count = count_col or _free_name(names, "n_entities")
    schema = T.StructType([*docs.schema.fields, T.StructField(count, T.LongType())])
    out = rows.mapInArrow(partial(_replace, key=key, text_at=names.index(text_col), few=few, drawn_at=drawn_at, keep=list(range(len(names))), count=count), schema)
    return out if count_col else out.drop(count)


def _free_name(names: list[str], name: str) -> str:
    taken = {n.lower() for n in names}
    while name in taken:
        name += "_"
    return name
