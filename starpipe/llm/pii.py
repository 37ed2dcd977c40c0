"""Format-preserving pseudonyms for personal data, in built-in functions only.

One pattern finds what may be a mail address, an account number, an address of a host, a date, a
social security number, a telephone number or a payment card. What passes its kind's validation is
replaced by another value of the same format: a Feistel network, keyed by a secret, permutes the
values of the format, so equal values have equal pseudonyms in all documents, different ones
different pseudonyms, and check digits stay right. Everything else in the text stays as it is.

A Feistel step adds to one half of a value a keyed hash of the other half, modulo the number of
values that half can take, which is a permutation for any two moduli; no value is ever outside the
format and nothing has to be tried twice.

The secret stays on the driver. A key derived from it comes in as a scalar subquery, so neither stands
in a plan, and with it in ``explain``, event logs or messages; executors hold the key in memory.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.llm.common import unused

ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Characters of an account number by country, so that a grouped one ends where it does. Fixed values of
#: the standard.
_IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(
    rf"(?:{names.replace(' ', '|')})\d\d(?:[ -]?[A-Z0-9]){{{size - 4}}}" for size, names in _IBAN_SIZES.items()
)

#: Candidates by kind, in the order in which they are tried at a place. Possessive quantifiers and
#: the conditions on what stands before keep the search linear in long runs of letters or digits.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBAN}|[A-Z]{{2}}\d\d[A-Z0-9]{{11,30}})(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "iso_date": r"(?<![\d-])\d{4}-\d\d-\d\d(?![\d-])|(?<![\d./])\d{4}(?<y>[./])\d\d\k<y>\d\d(?![\d/]|\.\d)",
    "date": r"(?<![\d./-])\d{1,2}(?<d>[./-])\d{1,2}\k<d>\d{4}(?![\d/]|-\d)",
    "ssn": r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
    r"|(?<![\d+])\+\d{1,3}[ .-]\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,5}(?!\d)"
    r"|(?<![\d.-])(?<!\d )\d{3}(?<p>[ .])\d{3}\k<p>\d{4}(?!\d|[ .]\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?<c>[ .-])\d{4}\k<c>\d{4}\k<c>\d{4}(?:\k<c>\d{1,3})?"
    r"|\d{4}(?<a>[ .-])\d{6}\k<a>\d{4,5})(?!\d)",
}
PATTERN = "|".join(PATTERNS.values())

#: Days in the calendar's cycle of 400 years, 189 * 773, counted from a year divisible by 400 less 200.
_CYCLE = (189, 773)
_FIRST_DAY = "1800-01-01"


def _hashed(secret: Column | str, kind: str, step: Column, value: Column) -> Column:
    """The hexadecimal digest of a half, under the secret."""
    return F.sha2(F.concat_ws("|", F.lit(secret), F.lit(kind), step.cast("string"), value), 256)


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def permute_pair(
    a: Column, size_a: Column, b: Column, size_b: Column, secret: Column | str, kind: str
) -> Column:
    """A keyed permutation of the pairs a < size_a, b < size_b; a struct of both."""

    def step(pair: Column, number: Column) -> Column:
        def moved(value: Column, other: Column, size: Column) -> Column:
            # 60 bits of the digest, so that the sum stays within a long.
            draw = _number(F.substring(_hashed(secret, kind, number, other.cast("string")), 1, 15))
            return F.pmod(value + draw, size)

        even = number % 2 == 0
        return F.struct(
            F.when(even, moved(pair["a"], pair["b"], size_a)).otherwise(pair["a"]).alias("a"),
            F.when(even, pair["b"]).otherwise(moved(pair["b"], pair["a"], size_b)).alias("b"),
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permute_text(text: Column, secret: Column | str, kind: str) -> Column:
    """A keyed permutation of the texts with the same places of digits, capitals, small letters.

    The text has two characters at least. Characters of other kinds stay.
    """

    def shifted(character: Column, by: Column) -> Column:
        code = F.ascii(character)

        def turn(first: str, size: int) -> Column:
            return F.char(ord(first) + F.pmod(code - ord(first) + by, F.lit(size)))

        return (
            F.when(code.between(ord("0"), ord("9")), turn("0", 10))
            .when(code.between(ord("A"), ord("Z")), turn("A", 26))
            .when(code.between(ord("a"), ord("z")), turn("a", 26))
            .otherwise(character)
        )

    def moved(value: Column, other: Column, number: Column) -> Column:
        digest = _hashed(secret, kind, number, other)
        places = F.sequence(F.lit(0), F.length(value) - 1)
        by = lambda i: _number(F.substr(digest, 2 * (i % 32) + 1, F.lit(2)))
        return F.array_join(
            F.transform(places, lambda i: shifted(F.substr(value, i + 1, F.lit(1)), by(i))), ""
        )

    def step(halves: Column, number: Column) -> Column:
        even = number % 2 == 0
        left, right = halves["a"], halves["b"]
        return F.struct(
            F.when(even, moved(left, right, number)).otherwise(left).alias("a"),
            F.when(even, right).otherwise(moved(right, left, number)).alias("b"),
        )

    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substr(text, F.lit(1), half).alias("a"),
        F.substr(text, half + 1, F.length(text)).alias("b"),
    )
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return F.concat(done["a"], done["b"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(shape: Column, digits: Column, places: str = "[0-9]") -> Column:
    """``shape`` with its digits, or what ``places`` matches, replaced, in order, by ``digits``."""
    between = F.split(shape, places, -1)
    return F.array_join(
        F.transform(between, lambda gap, i: F.concat(gap, F.substr(digits, i + 1, F.lit(1)))), ""
    )


def _permute_digits(digits: Column, secret: Column | str, kind: str) -> Column:
    """Of 2 to 36 digits, as many again."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, size)
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
    # The length belongs to the format: numbers of different lengths are permuted differently.
    done = permute_pair(
        left.cast("long"), power(half), right.cast("long"), power(size - half), secret, kind
    )
    return F.concat(
        F.lpad(done["a"].cast("string"), half, "0"), F.lpad(done["b"].cast("string"), size - half, "0")
    )


def _digit_list(digits: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.length(digits)), lambda i: F.substr(digits, i, F.lit(1)).cast("int")
    )


def luhn(digits: Column) -> Column:
    """The weighted sum of a payment card's digits; a valid one's is divisible by 10."""
    size = F.length(digits)

    def weighed(digit: Column, i: Column) -> Column:
        double = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when((size - i) % 2 == 0, double).otherwise(digit)

    return F.aggregate(
        F.transform(_digit_list(digits), weighed), F.lit(0), lambda total, digit: total + digit
    )


def _mod_97(text: Column) -> Column:
    """Of the number that digits, and letters as 10 to 35, spell."""

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(text, i, F.lit(1)))
        return F.when(code < ord("A"), (rest * 10 + code - ord("0")) % 97).otherwise(
            (rest * 100 + code - ord("A") + 10) % 97
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _email(value: Column, secret: Column | str) -> Column:
    """All but the last label."""
    last = F.regexp_extract(value, r"\.[A-Za-z0-9-]+$", 0)
    head = F.substr(value, F.lit(1), F.length(value) - F.length(last))
    return F.concat(permute_text(head, secret, "email"), last)


def _iban(written: Column, secret: Column | str) -> Column:
    value = F.regexp_replace(written, "[ -]", "")
    country, account = F.substr(value, F.lit(1), F.lit(2)), F.substr(value, F.lit(5))
    check = F.substr(value, F.lit(3), F.lit(2))
    new = permute_text(account, secret, "iban")
    check_of = F.lpad((98 - _mod_97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    valid = _mod_97(F.concat(account, country, check)) == 1
    return F.when(valid, _refill(written, F.concat(country, check_of, new), "[A-Z0-9]")).otherwise(written)


def _ip(value: Column, secret: Column | str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    size = F.lit(1 << 16)
    done = permute_pair(
        octets[0] * 256 + octets[1], size, octets[2] * 256 + octets[3], size, secret, "ip"
    )
    parts = [F.floor(done[half] / 256) if high else done[half] % 256 for half in "ab" for high in (1, 0)]
    return F.concat_ws(".", *[part.cast("string") for part in parts])


def _permuted_day(day: Column, secret: Column | str) -> Column:
    first = F.to_date(F.lit(_FIRST_DAY))
    days = _CYCLE[0] * _CYCLE[1]
    number = F.datediff(day, first)
    place = F.pmod(number, F.lit(days))
    done = permute_pair(
        F.floor(place / _CYCLE[1]), F.lit(_CYCLE[0]), place % _CYCLE[1], F.lit(_CYCLE[1]), secret, "date"
    )
    return F.date_add(first, (number - place + done["a"] * _CYCLE[1] + done["b"]).cast("int"))


def _iso_date(written: Column, secret: Column | str) -> Column:
    value = F.regexp_replace(written, "[./]", "-")
    new = F.date_format(_permuted_day(F.try_to_date(value, "yyyy-MM-dd"), secret), "yyyy-MM-dd")
    # Days that leave the years of four digits stay.
    return F.when(F.length(new) == 10, _refill(written, _digits(new))).otherwise(written)


def _date(value: Column, secret: Column | str) -> Column:
    """Days first with dots; with slashes months first, with hyphens days, where that is a date."""
    is_date = lambda form: F.try_to_date(value, form).isNotNull()
    tried = [
        (value.contains("."), "d.M.yyyy"),
        (value.contains("/") & is_date("M/d/yyyy"), "M/d/yyyy"),
        (value.contains("/"), "d/M/yyyy"),
        (value.contains("-") & is_date("d-M-yyyy"), "d-M-yyyy"),
        (value.contains("-"), "M-d-yyyy"),
    ]
    day = form = F.lit(None)
    for condition, tried_form in reversed(tried):
        day = F.when(condition, F.try_to_date(value, tried_form)).otherwise(day)
        form = F.when(condition, tried_form).otherwise(form)
    padded = value.rlike(r"^\d\d.\d\d.")

    def written(day: Column) -> Column:
        result = F.lit(None).cast("string")
        for _, tried_form in tried:
            wide = tried_form.replace("d", "dd").replace("M", "MM")
            new = F.when(padded, F.date_format(day, wide)).otherwise(F.date_format(day, tried_form))
            result = F.when(form == tried_form, new).otherwise(result)
        return result

    # A list of one, so that the day is computed once for all forms.
    result = F.transform(F.array(_permuted_day(day.cast("date"), secret)), written)[0]
    return F.when(result.rlike(r"^\d{1,2}.\d{1,2}.\d{4}$"), result).otherwise(value)


def _ssn(value: Column, secret: Column | str) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    part = lambda i: F.split(value, "-")[i].cast("long")
    area, group, serial = part(0), part(1), part(2)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    done = permute_pair(
        area - F.when(area > 666, 2).otherwise(1), F.lit(898),
        (group - 1) * 9999 + serial - 1, F.lit(99 * 9999), secret, "ssn",
    )
    new_area = done["a"] + F.when(done["a"] >= 665, 2).otherwise(1)
    new = F.format_string(
        "%03d-%02d-%04d", new_area, F.floor(done["b"] / 9999) + 1, done["b"] % 9999 + 1
    )
    return F.when(valid, new).otherwise(value)


def _phone(value: Column, secret: Column | str) -> Column:
    """All digits but those that follow the plus sign directly; 7 to 15 digits in all."""
    country = F.regexp_extract(value, r"^\+(\d{1,3}(?=\D)|\d)", 0)
    rest = F.substr(value, F.length(country) + 1, F.length(value))
    digits = _digits(rest)
    new = _refill(rest, _permute_digits(digits, secret, "phone"))
    valid = F.length(_digits(value)).between(7, 15) & (F.length(digits) >= 2)
    return F.when(valid, F.concat(country, new)).otherwise(value)


def _card(value: Column, secret: Column | str) -> Column:
    """All digits but the first, which names the kind of issuer; the last is the check digit.

    A number behind the four groups of a card may belong to it or not; the check digit tells.
    """
    head = F.substr(value, F.lit(1), F.lit(19))
    more = value.rlike(r"^(\d{4}[ .-]){4}\d") & (luhn(_digits(head)) % 10 == 0)
    valid = F.when(luhn(_digits(value)) % 10 == 0, value).when(more, head)

    def changed(card: Column) -> Column:
        return F.concat(_permuted_card(card, secret), F.substr(value, F.length(card) + 1))

    return F.coalesce(F.transform(F.array(valid), changed)[0], value)


def _permuted_card(value: Column, secret: Column | str) -> Column:
    digits = _digits(value)
    size = F.length(digits)
    first, middle = F.substr(digits, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2), size - 2)
    body = F.concat(first, _permute_digits(middle, secret, "card"))
    check = F.pmod(-luhn(F.concat(body, F.lit("0"))), F.lit(10))
    return _refill(value, F.concat(body, check.cast("string")))


def pseudonym(value: Column, secret: Column | str) -> Column:
    """Another value of the same format; what isn't valid in its format stays as it is."""
    return (
        F.when(value.contains("@"), _email(value, secret))
        .when(value.rlike("^[A-Z]"), _iban(value, secret))
        .when(value.rlike(r"^\d+\.\d+\.\d+\.\d+$"), _ip(value, secret))
        .when(value.rlike(r"^\d{4}([-./])\d\d\1\d\d$"), _iso_date(value, secret))
        .when(value.rlike(r"^\d{1,2}([./-])\d{1,2}\1\d{4}$"), _date(value, secret))
        .when(value.rlike(r"^\d{3}-\d\d-\d{4}$"), _ssn(value, secret))
        .when(value.rlike(r"^[+(]|^\d{3}([ .-])\d{3}\1\d{4}$"), _phone(value, secret))
        .otherwise(_card(value, secret))
    )


def derived_key(spark: SparkSession, secret: str) -> DataFrame:
    """One row with a key of the secret, from which the secret can't be found."""
    key = hmac.new(secret.encode(), b"pseudonyms", hashlib.sha256).hexdigest()
    return spark.sql("SELECT * FROM VALUES (:key) AS t(key)", args={"key": key})


def pseudonymise(
    docs: DataFrame, secret: str, text: str = "text", count: str | None = None
) -> DataFrame:
    """``docs`` with pseudonyms in its ``text`` column; ``count`` adds how many were put in.

    Nothing is shuffled; each row is judged by itself, so repeated rows stay equal. Null texts
    stay null and empty ones empty, with a count of 0. Other columns pass unchanged, whatever their
    names; one named like ``count`` is replaced. An empty table gives an empty result.
    """
    if not secret:
        raise ValueError("pseudonyms need a secret")
    original = F.col(f"`{text}`")
    key_name, pairs_name = unused(docs, "__key"), unused(docs, "__pairs")
    keyed = docs.withColumn(key_name, derived_key(docs.sparkSession, secret).scalar())
    # A cheap test first: every kind has a digit or an @.
    touched = original.rlike("[0-9@]")
    found = F.when(touched, F.regexp_extract_all(original, F.lit(PATTERN), F.lit(0)))
    pairs = F.transform(found, lambda old: F.struct(old.alias("old"), pseudonym(old, F.col(key_name)).alias("new")))
    gaps = F.split(original, PATTERN, -1)
    filled = F.array_join(
        F.transform(
            gaps,
            lambda gap, i: F.concat(
                gap, F.coalesce(F.get(F.col(pairs_name), i)["new"], F.get(F.col(pairs_name), i)["old"], F.lit(""))
            ),
        ),
        "",
    )
    replaced = F.size(F.filter(F.col(pairs_name), lambda pair: pair["old"] != pair["new"])).cast("long")
    kept = [c for c in docs.columns if c != count]
    columns = [
        F.when(F.size(pairs_name) > 0, filled).otherwise(original).alias(c) if c == text else F.col(f"`{c}`")
        for c in kept
    ]
    if count is not None:
        columns.append(F.when(F.size(pairs_name) > 0, replaced).otherwise(F.lit(0)).alias(count))
    return keyed.withColumn(pairs_name, pairs).select(*columns)
