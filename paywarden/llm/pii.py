r"""Format-preserving Feistel pseudonyms, in DataFrame functions only.

Values are found by one pattern, checked (Luhn digit, remainder of 97, octets, calendar),
and replaced by the image of a keyed permutation of their own format:

* a number or mixed string is halved; in each round every character of one half
  moves within its class (digits, small letters, capital letters) by a keyed hash of
  the other half; all other characters stay, so the format does;
* of card, account and phone numbers only the digits and letters are permuted, and the
  blanks, dashes and brackets put back: one number has one pseudonym in all its spellings;
* check digits of card and account numbers are made anew, so they stay valid, and so do
  the parts of a social security number;
* an IPv4 address is two halves of 16 bits, an IPv6 address two of 64, written in full;
* a date is a day of the 400 years from 1800, written as 189 x 773, and stays in
  the way it was written; with two digits for the year it is one of the 100 years from
  1970, as 75 x 487, and not linked with the same day in four digits.

Each round can be undone by who has the key, so the whole is a permutation: equal
values stay equal in all documents, different ones different.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import unused

ROUNDS = 8  # even, so that the halves end in their places
FIRST_DAY, CYCLE_DAYS, DAY_PARTS = "1800-01-01", 146_097, (189, 773)  # 400 years; the parts multiply to the days
SHORT_FIRST, SHORT_DAYS, SHORT_PARTS = "1970-01-01", 36_525, (75, 487)  # 100 years, for years of two digits
SSN_AREAS, SSN_GROUPS, SSN_SERIALS = 898, 99, 9_999  # areas 001 to 899 without 666, groups and serials from 1

# Characters of an account number (IBAN) by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}
# Country codes of phone numbers that have fewer than three digits.
COUNTRY_CODE = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
# What the tokens of well-known services begin with.
TOKEN_PREFIX = r"(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-(?:proj-)?)"
MONTHS = "January February March April May June July August September October November December".split()

_ALONE, _END = r"(?<![\p{L}\p{N}_.])", r"(?![\p{L}\p{N}_])"
_GROUP = r"\d{1,19}+" + _END
# What may follow a card number after a blank and is a value of its own.
_MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + "|Sept"
_OTHER = (
    r"\d{4}[-/]\d{2}[-/]\d{2}" + _END + r"|\d{2}\.\d{2}\.\d{4}" + _END + r"|\d{1,2}/\d{1,2}/(?:\d{4}|\d{2})" + _END
    + rf"|\d{{1,2}} (?:{_MONTH})\b|\d{{3}}-\d{{2}}-\d{{4}}" + _END + r"|[2-9]\d{2}[-.][2-9]\d{2}[-.]\d{4}" + _END
    + r"|[0-9A-Fa-f]{1,4}:|\d{1,3}(?:\.\d{1,3}){3}|[A-Za-z0-9._%+-]{1,64}+@"
)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}+",
    "date": _ALONE + r"(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{1,2}/\d{1,2}/(?:\d{4}|\d{2}))" + r"(?![\p{L}\p{N}_/])",
    "named_date": _ALONE + rf"(?:(?:{_MONTH})\.? \d{{1,2}},? \d{{4}}|\d{{1,2}} (?:{_MONTH})\.? \d{{4}})" + _END,
    "ip": _ALONE + r"\d{1,3}(?:\.\d{1,3}){3}(?![\p{L}\p{N}_]|\.\d)",
    # Eight groups, or fewer around a double colon; a first group without a digit may as well be a name in a program.
    "ipv6": r"(?<![\p{L}\p{N}_.:])(?=[A-Fa-f]{0,3}[0-9])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"
    r"|[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,5}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})(?![\p{L}\p{N}_:])",
    "iban": _ALONE + r"(?=[A-Z]{2}\d{2})(?:"
    + "|".join(rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, countries in IBAN_LENGTHS.items())
    + ")" + _END,
    "ssn": _ALONE + r"(?<!-)(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?!-)" + _END,
    "phone": r"(?<![\p{L}\p{N}_])\+\d{1,3}[ -]?(?:\(\d{2,4}\)|\d{2,4})(?:[ -]?\d{2,4}){2,3}" + _END,
    # Ten digits as they are written in North America: they are those after +1.
    "national": r"(?<![\p{L}\p{N}_.+-])(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[-.])[2-9]\d{2}[-.]\d{4}(?![\p{L}\p{N}_]|[-.]\d)",
    # Groups of digits, as many as there are: the number is looked for among them.
    "card": _ALONE + r"(?=\d(?:[ -]?\d){12,18}" + _END + ")" + _GROUP + rf"(?:[ -](?!{_OTHER}){_GROUP})*+",
    "secret": r"(?<![\p{L}\p{N}_-])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{22,}+"
    r"|glpat-[A-Za-z0-9_-]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk-(?:proj-)?(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{20,}+)" + _END
    + r"|(?<=(?i:token|passwd|secret)[ ]?[=:][ ]?[\"']?|(?i:password|api_key)[ ]?[=:][ ]?[\"']?)[A-Za-z0-9+/_-]{8,}+",
}
PATTERN = "|".join(PATTERNS.values())
#: Without one of these no value can be there.
HINT = "[0-9@]|(?i:token|passw|secret|api_key)|A[KS]IA|gh[pousr]_|github_pat_|glpat-|xox[abprs]-"


def _hash(key: str, kind: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)


def round_key(secret: str) -> str:
    """A key made of a secret that cannot be told from it, as keys can be read in plans and event logs."""
    return hashlib.sha256(f"pseudonyms|{secret}".encode()).hexdigest()


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named; an expression in its place would be copied each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _turns() -> Column:
    return F.array(*(F.lit(k) for k in range(ROUNDS)))


def _moved(half: Column, stream: Column) -> Column:
    """Each character moved within its class by a byte of the hex stream."""

    def one(c: Column, at: Column, bits: Column) -> Column:
        step = F.conv(bits.substr(at % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        within = lambda first, size: F.char(first + (code - first + step) % size)
        return (
            F.when(code.between(48, 57), within(48, 10))
            .when(code.between(65, 90), within(65, 26))
            .when(code.between(97, 122), within(97, 26))
            .otherwise(c)
        )

    return _let(stream, lambda bits: F.array_join(F.transform(F.split(half, ""), lambda c, at: one(c, at, bits)), ""))


def permuted_string(value: Column, key: str, kind: str) -> Column:
    """The image of a string among the strings of its format."""

    def turn(s: Column, k: Column) -> Column:
        return F.struct(s["b"].alias("a"), _moved(s["a"], _hash(key, kind, k, s["b"])).alias("b"))

    def image(whole: Column) -> Column:
        half = F.floor(F.length(whole) / 2).cast("int")
        start = F.struct(whole.substr(F.lit(1), half).alias("a"), whole.substr(half + 1, F.length(whole)).alias("b"))
        return F.aggregate(_turns(), start, turn, lambda s: F.concat(s["a"], s["b"]))

    return _let(value, image)


def permuted_signs(value: Column, key: str, kind: str) -> Column:
    """The digits and letters of a string permuted as one string, whatever stands between them, and that put back."""

    def put(s: Column, c: Column) -> Column:
        sign = c.rlike("[0-9A-Za-z]")
        return F.struct(
            F.when(sign, s["left"].substr(F.lit(2), F.length(s["left"]))).otherwise(s["left"]).alias("left"),
            F.concat(s["text"], F.when(sign, s["left"].substr(F.lit(1), F.lit(1))).otherwise(c)).alias("text"),
        )

    signs = permuted_string(F.regexp_replace(value, "[^0-9A-Za-z]", ""), key, kind)
    return F.aggregate(F.split(value, ""), F.struct(signs.alias("left"), F.lit("").alias("text")), put, lambda s: s["text"])


def permuted_pair(a: Column, b: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """The image of a pair of numbers below the two sizes, as a struct of a and b."""

    def shift(turn: Column, value: Column, size: int) -> Column:
        return F.conv(F.substring(_hash(key, kind, turn, value), 1, 15), 16, 10).cast("long") % size

    def step(s: Column, k: Column) -> Column:
        return F.struct(
            F.when(k % 2 == 0, (s["a"] + shift(k, s["b"], sizes[0])) % sizes[0]).otherwise(s["a"]).alias("a"),
            F.when(k % 2 == 1, (s["b"] + shift(k, s["a"], sizes[1])) % sizes[1]).otherwise(s["b"]).alias("b"),
        )

    return F.aggregate(_turns(), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum, doubling each second digit from the right, beginning with the last (0) or last but one (1)."""
    one = lambda c, at: F.when(at % 2 == doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda n, x: n + x)


def _card_number(value: Column, key: str) -> Column:
    body = value.substr(F.lit(1), F.length(value) - 1)

    def checked(moved: Column) -> Column:
        check = (F.lit(10) - luhn_sum(F.regexp_replace(moved, "[^0-9]", ""), 0) % 10) % 10
        return F.concat(moved, check.cast("string"))

    return _let(permuted_signs(body, key, "card"), checked)


def _cards(value: Column, key: str) -> Column:
    """The groups of digits with pseudonyms for the card numbers among them (text), and how many there are (n).

    From each group on, the longest of 13 to 19 digits that ends with a group and passes
    the Luhn check is taken. Among groups of one or two digits, which any numbers may be,
    only the longest is tried, and the next after it.
    """
    groups = F.split(value, "(?<=[ -])")  # each with the blank or dash after it

    def step(s: Column, i: Column) -> Column:
        def part(j: Column) -> Column:
            text = F.regexp_replace(F.array_join(F.slice(groups, i + 1, j - i + 1), ""), "[ -]$", "")
            return F.struct(j.alias("j"), text.alias("text"), F.regexp_replace(text, "[^0-9]", "").alias("digits"))

        parts = F.filter(
            F.transform(F.sequence(i, F.least(i + 18, F.size(groups) - 1)), part), lambda p: F.length(p["digits"]).between(13, 19)
        )
        longest = F.coalesce(F.array_max(F.transform(parts, lambda p: p["j"])), i)
        good = F.filter(
            parts,
            lambda p: (((i == s["fresh"]) & (p["j"] == longest)) | ~p["text"].rlike(r"(?<!\d)\d{1,2}(?!\d)"))
            & (luhn_sum(p["digits"], 1) % 10 == 0),
        )
        won = F.get(good, F.size(good) - 1)
        rest = F.regexp_extract(F.get(groups, won["j"]), "[ -]$", 0)
        group = F.get(groups, i)

        def state(text: Column, n: Column, after: Column, fresh: Column) -> Column:
            return F.struct(text.alias("text"), n.alias("n"), after.cast("int").alias("after"), fresh.cast("int").alias("fresh"))

        return (
            F.when(i < s["after"], s)
            .when(F.size(good) > 0, state(F.concat(s["text"], _card_number(won["text"], key), rest), s["n"] + 1, won["j"] + 1, won["j"] + 1))
            .otherwise(state(F.concat(s["text"], group), s["n"], i + 1, F.when(i == s["fresh"], longest + 1).otherwise(s["fresh"])))
        )

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("after"), F.lit(0).alias("fresh"))
    done = F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step)
    return F.when(done["n"] > 0, F.struct(done["text"].alias("text"), done["n"].alias("n")))


def _ip(value: Column, key: str) -> Column:
    def image(part: Column) -> Column:
        moved = permuted_pair(part[0] * 256 + part[1], part[2] * 256 + part[3], (1 << 16, 1 << 16), key, "ip")
        written = lambda m: F.concat_ws(".", *(F.floor(m[h] / 256) if high else m[h] % 256 for h in "ab" for high in (True, False)))
        return F.when(F.forall(part, lambda x: x < 256), _let(moved, written))

    return _let(F.transform(F.split(value, r"\."), lambda x: x.cast("int")), image)


def _ipv6(value: Column, key: str) -> Column:
    def image(ends: Column) -> Column:
        before, after = F.split(ends[0], ":"), F.when(F.size(ends) > 1, F.split(ends[1], ":")).otherwise(F.array().cast("array<string>"))
        between = F.lit(8) - F.size(before) - F.size(after)
        return F.when(
            F.when(F.size(ends) > 1, between > 0).otherwise(between == 0),
            _let(F.concat(before, F.array_repeat(F.lit("0"), between), after), moved),
        )

    def moved(groups: Column) -> Column:
        digits = F.array_join(F.transform(groups, lambda g: F.lpad(F.lower(g), 4, "0")), "")
        number = lambda first: F.conv(digits.substr(F.lit(first), F.lit(16)), 16, -10).cast("long")

        def turn(s: Column, k: Column) -> Column:
            noise = F.conv(F.substring(_hash(key, "ipv6", k, s["b"]), 1, 16), 16, -10).cast("long")
            return F.struct(s["b"].alias("a"), s["a"].bitwiseXOR(noise).alias("b"))

        start = F.struct(number(1).alias("a"), number(17).alias("b"))
        full = F.aggregate(_turns(), start, turn, lambda s: F.concat(*(F.lpad(F.lower(F.hex(s[h])), 16, "0") for h in "ab")))
        return F.array_join(F.regexp_extract_all(full, F.lit("0{0,3}([0-9a-f]{1,4}?)(?=(?:[0-9a-f]{4})*$)"), F.lit(1)), ":")

    return _let(F.split(value, "::"), image)


def _day_moved(day: Column, short: Column, key: str) -> Column:
    """The image of a day among the days of its cycle; null outside of it."""

    def image(first: str, days: int, parts: tuple[int, int], kind: str) -> Column:
        def within(n: Column) -> Column:
            pair = permuted_pair(F.floor(n / parts[1]), n % parts[1], parts, key, kind)
            out = _let(pair, lambda m: F.date_add(F.lit(first).cast("date"), (m["a"] * parts[1] + m["b"]).cast("int")))
            return F.when(n.between(0, days - 1), out)

        return _let(F.date_diff(day, F.lit(first).cast("date")), within)

    return F.when(short, image(SHORT_FIRST, SHORT_DAYS, SHORT_PARTS, "short_date")).otherwise(image(FIRST_DAY, CYCLE_DAYS, DAY_PARTS, "date"))


def _date(value: Column, key: str) -> Column:
    def image(part: Column) -> Column:
        by_year = F.length(part[0]) == 4
        short = ~by_year & (F.length(part[2]) == 2)
        dash, dot = F.contains(value, F.lit("-")), F.contains(value, F.lit("."))
        century = F.when(short, F.when(part[2].cast("int") < 70, "20").otherwise("19")).otherwise("")
        text = (
            F.when(by_year, F.concat_ws("-", part[0], part[1], part[2]))
            .when(dot, F.concat_ws("-", part[2], part[1], part[0]))
            .otherwise(F.concat_ws("-", F.concat(century, part[2]), F.lpad(part[0], 2, "0"), F.lpad(part[1], 2, "0")))
        )
        padded = (F.length(part[0]) == 2) & (F.length(part[1]) == 2)

        def written(out: Column) -> Column:
            year = F.when(short, F.date_format(out, "yy")).otherwise(F.date_format(out, "yyyy"))
            return (
                F.when(by_year & dash, F.date_format(out, "yyyy-MM-dd"))
                .when(by_year, F.date_format(out, "yyyy/MM/dd"))
                .when(dot, F.date_format(out, "dd.MM.yyyy"))
                .when(padded, F.concat(F.date_format(out, "MM/dd/"), year))
                .otherwise(F.concat(F.date_format(out, "M/d/"), year))
            )

        return _let(_day_moved(F.try_to_date(text, "yyyy-MM-dd"), short, key), written)

    return _let(F.split(value, r"[-./]"), image)


def _named_date(value: Column, key: str) -> Column:
    names = F.array(*(F.lit(m) for m in MONTHS))

    def image(part: Column) -> Column:
        first = part[0].rlike("^[A-Z]")  # the month stands first
        name, day = F.when(first, part[0]).otherwise(part[1]), F.when(first, part[1]).otherwise(part[0])
        month = F.array_position(F.transform(names, lambda m: F.substring(m, 1, 3)), F.substring(name, 1, 3))
        text = F.concat_ws("-", part[2], F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
        whole = F.exists(names, lambda m: m == name)  # May is both: it is taken as a whole name
        mark, comma = F.when(F.contains(value, F.lit(".")), ".").otherwise(""), F.when(F.contains(value, F.lit(",")), ",").otherwise("")

        def written(out: Column) -> Column:
            new = F.get(names, F.month(out) - 1)
            new = F.concat(F.when(whole, new).otherwise(F.substring(new, 1, 3)), mark)
            number, year = F.dayofmonth(out).cast("string"), F.date_format(out, "yyyy")
            return F.when(out.isNotNull(), F.when(first, F.concat(new, F.lit(" "), number, comma, F.lit(" "), year)).otherwise(F.concat_ws(" ", number, new, year)))

        return _let(_day_moved(F.try_to_date(text, "yyyy-MM-dd"), F.lit(False), key), written)

    return _let(F.split(value, r"[., ]+"), image)


def _remainder(text: Column) -> Column:
    """The remainder by 97 of a number in which letters stand for 10 to 35."""

    def step(n: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code > 64, n * 100 + code - 55).otherwise(n * 10 + code - 48) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(value: Column, key: str) -> Column:
    country = F.substring(value, 1, 2)

    def checked(moved: Column) -> Column:
        check = F.lit(98) - _remainder(F.concat(F.regexp_replace(moved, " ", ""), country, F.lit("00")))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), moved)

    signs = F.regexp_replace(value, " ", "")
    good = _let(signs, lambda t: _remainder(F.concat(t.substr(F.lit(5), F.length(t)), F.substring(t, 1, 4)))) == 1
    return F.when(good, _let(permuted_signs(value.substr(F.lit(5), F.length(value)), key, "iban"), checked))


def _ssn(value: Column, key: str) -> Column:
    part = lambda first, size: F.substring(value, first, size).cast("int")
    area = part(1, 3) - F.when(part(1, 3) > 666, 2).otherwise(1)  # from 0, without 666

    def written(m: Column) -> Column:
        place = F.floor(m["a"] / SSN_GROUPS)
        return F.format_string("%03d-%02d-%04d", place + F.when(place < 665, 1).otherwise(2), m["a"] % SSN_GROUPS + 1, m["b"] + 1)

    return _let(permuted_pair(area * SSN_GROUPS + part(5, 2) - 1, part(8, 4) - 1, (SSN_AREAS * SSN_GROUPS, SSN_SERIALS), key, "ssn"), written)


def _email(value: Column, key: str) -> Column:
    return F.concat(permuted_string(F.substring_index(value, "@", 1), key, "email"), F.lit("@"), F.substring_index(value, "@", -1))


def _phone(value: Column, key: str) -> Column:
    """The digits of the country stay, though blanks may stand after, among or before them."""
    size = F.length(F.regexp_extract(F.regexp_replace(value, "[^0-9]", ""), COUNTRY_CODE, 0))
    shape = r"^\+(?:[^0-9]*[0-9]){"
    country = F.when(size == 1, F.regexp_extract(value, shape + "1}", 0)).when(size == 2, F.regexp_extract(value, shape + "2}", 0))
    country = country.otherwise(F.regexp_extract(value, shape + "3}", 0))
    return _let(country, lambda c: F.concat(c, permuted_signs(value.substr(F.length(c) + 1, F.length(value)), key, "phone")))


def _national(value: Column, key: str) -> Column:
    return permuted_signs(value, key, "phone")


def _secret(value: Column, key: str) -> Column:
    fixed = F.regexp_extract(value, f"^{TOKEN_PREFIX}", 0)
    return _let(fixed, lambda f: F.concat(f, permuted_string(value.substr(F.length(f) + 1, F.length(value)), key, "secret")))


RULES: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "date": _date, "named_date": _named_date, "ip": _ip, "ipv6": _ipv6, "iban": _iban, "ssn": _ssn,
    "phone": _phone, "national": _national, "secret": _secret,
}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found value (text) and how many values it held (n); null if the value does not pass its check."""
    out = F.lit(None).cast("struct<text: string, n: int>")
    for kind in list(PATTERNS)[::-1]:
        whole = value.rlike(f"^(?:{PATTERNS[kind]})$") if kind != "secret" else F.lit(True)
        if kind == "card":
            new = _cards(value, key)
        else:
            new = _let(RULES[kind](value, key), lambda text: F.when(text.isNotNull(), F.struct(text.alias("text"), F.lit(1).alias("n"))))
        out = F.when(whole, new).otherwise(out)
    return out


@lru_cache(maxsize=4)
def _replacements(app: str, key: str) -> Column:
    """What was found in `text` (old) and its pseudonyms (new). Putting the expression together takes seconds, so it is kept for the application."""
    found = F.regexp_extract_all(F.col("text"), F.lit(PATTERN), F.lit(0))
    return F.transform(found, lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))


def pseudonymised(docs: DataFrame, key: str, kept: list[str] | None = None) -> DataFrame:
    """The documents with pseudonyms in `text`; with `kept`, only those columns, text and n_values (values replaced).

    Null text stays null and has no values; an empty text stays empty; values that
    fail their check stay as they are; repeated rows and ties come out alike; an
    empty table gives no rows. Helper columns take names that are free, so others may have any name.
    The key stands in the plan: pass a `round_key`.
    """
    docs = docs.withColumn("text", docs["text"].cast("string"))
    text = F.col("text")
    values = F.when(text.rlike(HINT), _replacements(docs.sparkSession.sparkContext.applicationId, key))
    parts, count = unused(docs, "parts"), unused(docs, "n_values")
    some = F.size(parts) > 0
    new = F.transform(parts, lambda p: F.coalesce(p["new"]["text"], p["old"]))
    joined = F.array_join(F.zip_with(F.split("text", PATTERN, -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    n = F.when(some, F.aggregate(parts, F.lit(0), lambda k, p: k + F.coalesce(p["new"]["n"], F.lit(0)))).otherwise(0)
    out = docs.withColumn(parts, values)
    changed = F.when(some, joined).otherwise(F.col("text")).alias("text")
    if kept is None:
        return out.select(*(changed if c == "text" else F.col(f"`{c}`") for c in docs.columns))
    return out.select(*(F.col(f"`{c}`") for c in kept), changed, n.cast("long").alias(count))
