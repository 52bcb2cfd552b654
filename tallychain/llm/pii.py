"""Format-preserving pseudonyms by keyed Feistel networks, in DataFrame operations.

Validated values are permuted within their format, so a pseudonym is a value of the
same form that passes the same validation, and equal values get equal pseudonyms in
every document:

    card    13 to 19 digits with a valid check digit; the digits before it are
            permuted and the check digit is made anew
    iban    valid modulo 97; the account part is permuted, letters to letters and
            digits to digits, and the check digits are made anew
    ssn     three, two and four digits with dashes that could be issued, permuted among
            those
    phone   (area) exchange-line numbers, permuted among valid area and exchange
            codes, or, if one of the two is below 200, among those with the same first
            digits of both; and numbers with a country code, of which two digits stay
    ip      four numbers up to 255, permuted as 32 bits
    date    year-month-day, day.month.year and day/month/year that exist, permuted
            within the 400-year cycle they lie in; month/day/year with a day from 13 to
            28 is permuted among those, with a later day only its year is
    email   the part before @, letters to letters and digits to digits

What fails its validation stays. A Feistel network is a permutation whatever its
round function; this one uses SHA-2 of key, kind, round and the other half.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "iban", "date", "ip", "ssn", "phone", "card")
ROUNDS = 8
#: For queries; a deployment passes its own secret.
DEMO_KEY = "replace this key"

_BY_AREA = r"(?:\+?[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}"
_BY_COUNTRY = r"\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,5}){2,5}"
_AREA_PHONE = rf"(?<![0-9A-Za-z+]){_BY_AREA}(?![0-9A-Za-z])"
#: Kinds told by their form: it says where they end.
_FORMS = {
    "date": r"(?<![0-9.\-/])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[.\-/][0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
}
_FORM = "|".join(_FORMS.values())
#: What any of the forms has in it, and what a phone of fixed length has that lacks it.
_MARKS, _BLANK_PHONE = r"[./\-(]", "[0-9]{3} [0-9]{3} [0-9]{4}"
#: A phone of the open-ended form may be followed by a separator and a digit only if a form starts with it.
_OPEN_END = rf"(?![0-9A-Za-z]|[ \-](?!{_FORM}|{_AREA_PHONE})[0-9])"
_PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+){0,126}",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    **_FORMS,
    "phone": rf"(?:{_AREA_PHONE}|(?<![0-9A-Za-z+]){_BY_COUNTRY}{_OPEN_END})",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])",
}
#: Where a value of some kind may start.
_START = "(?=" + "|".join(f"(?:{_PATTERNS[k]})" for k in KINDS) + ")"
#: What lies ahead there: an e-mail name (nothing else that starts with it is longer), or as much
#: as the longest two of the other kinds take.
_AHEAD = rf"(?=({_PATTERNS['email']}|(?s:.{{0,72}})))"
_IBANS = [
    rf"(?<![0-9A-Za-z])[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}"
    + (f" ?[A-Z0-9]{{{rest}}}" if rest else "") + "(?![0-9A-Za-z])"
    for fours in range(2, 8) for rest in range(4)
]
_CARDS = [rf"(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){{{n - 1}}}(?![0-9A-Za-z])" for n in range(13, 20)]
#: Of 8 to 20 digits; each must also be all of ``_BY_COUNTRY``.
_COUNTRY_PHONES = [
    rf"(?<![0-9A-Za-z+])\+[0-9](?:[ .\-]?[0-9]){{{n - 1}}}{_OPEN_END}" for n in range(8, 21)
]
#: What a text must have to hold any of them.
_HINT = r"[0-9@]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` has it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _number(text: Column) -> Column:
    return text.cast("long")


def _draw(key: str, tag: Column, turn: Column, half: Column) -> Column:
    """60 bits from key, tag, round and half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tag, turn.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(value: Column, a: Column, b: Column, key: str, tag: Column, inverse: bool = False) -> Column:
    """A keyed permutation of 0 .. a * b - 1: two parts, modulo a and b, added to in turn."""
    sign = -1 if inverse else 1

    def permuted(given: Column) -> Column:
        m, n, name = given["a"], given["b"], given["tag"]

        def step(s: Column, i: Column) -> Column:
            return F.when(
                i % 2 == 0,
                F.struct(F.pmod(s["x"] + sign * (_draw(key, name, i, s["y"]) % m), m).alias("x"), s["y"].alias("y")),
            ).otherwise(
                F.struct(s["x"].alias("x"), F.pmod(s["y"] + sign * (_draw(key, name, i, s["x"]) % n), n).alias("y"))
            )

        parts = F.struct(F.floor(given["value"] / n).alias("x"), F.pmod(given["value"], n).alias("y"))
        return F.aggregate(_turns(inverse), parts, step, lambda s: s["x"] * n + s["y"])

    return _let(F.struct(value.alias("value"), a.alias("a"), b.alias("b"), tag.alias("tag")), permuted)


def _turns(inverse: bool) -> Column:
    return F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))


def _power(n: Column) -> Column:
    return F.element_at(F.array(*[F.expr(f"{10 ** i}L") for i in range(10)]), (n + 1).cast("int"))


def feistel_digits(digits: Column, key: str, tag: Column, inverse: bool = False) -> Column:
    """A permutation of the digit strings of one length, up to 18 digits."""

    def permuted(own: Column) -> Column:
        n = F.length(own)
        half = F.floor(n / 2)
        out = feistel(_number(own), _power(n - half), _power(half), key, F.concat(tag, n.cast("string")), inverse)
        return F.lpad(out.cast("string"), n, "0")

    return _let(digits, permuted)


def _shift(part: Column, other: Column, key: str, tag: Column, turn: Column, sign: int) -> Column:
    """Each letter or digit of ``part`` moved within its class by what ``other`` draws."""
    stream = F.sha2(F.concat_ws("|", F.lit(key), tag, turn.cast("string"), other), 512)

    def moved(draws: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            # 40 draws of three hex digits; what is longer draws from the start again, with its place.
            draw = F.conv(F.substr(draws, (i % 40) * 3 + 1, F.lit(3)), 16, 10).cast("int") + i
            code = F.ascii(c)

            def within(first: int, size: int) -> Column:
                return F.char(F.pmod(code - first + sign * draw, F.lit(size)) + first)

            return (
                F.when(c.rlike("^[0-9]$"), within(48, 10))
                .when(c.rlike("^[A-Z]$"), within(65, 26))
                .when(c.rlike("^[a-z]$"), within(97, 26))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.split(part, ""), one), "")

    return F.when(part == "", part).otherwise(_let(stream, moved))


def feistel_text(text: Column, key: str, tag: Column, inverse: bool = False) -> Column:
    """A permutation of the strings of one pattern of digits, upper and lower case letters."""
    sign = -1 if inverse else 1

    def permuted(given: Column) -> Column:
        own, name = given["text"], given["tag"]
        half = F.floor(F.length(own) / 2).cast("int")
        parts = F.struct(
            F.substr(own, F.lit(1), half).alias("x"), F.substr(own, half + 1, F.length(own)).alias("y")
        )

        def step(s: Column, i: Column) -> Column:
            return F.when(
                i % 2 == 0, F.struct(_shift(s["x"], s["y"], key, name, i, sign).alias("x"), s["y"].alias("y"))
            ).otherwise(F.struct(s["x"].alias("x"), _shift(s["y"], s["x"], key, name, i, sign).alias("y")))

        return F.aggregate(_turns(inverse), parts, step, lambda s: F.concat(s["x"], s["y"]))

    return _let(F.struct(text.alias("text"), tag.alias("tag")), permuted)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _laid_out(form: Column, new: Column, what: str) -> Column:
    """``form`` with its characters of the class ``what`` replaced by those of ``new`` in turn."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def filled(made: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            own = c.rlike(f"^{what}$")
            return F.struct(
                F.concat(s["out"], F.when(own, F.substr(made, s["next"], F.lit(1))).otherwise(c)).alias("out"),
                F.when(own, s["next"] + 1).otherwise(s["next"]).alias("next"),
            )

        return F.aggregate(F.split(form, ""), start, step, lambda s: s["out"])

    return _let(new, filled)


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum with every second digit from the right doubled, the last one not."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int"))
        .when(c.cast("int") > 4, 2 * c.cast("int") - 9)
        .otherwise(2 * c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def _card(value: Column, key: str, inverse: bool) -> Column:
    payload = _let(_digits(value), lambda d: F.substr(d, F.lit(1), F.length(d) - 1))

    def checked(new: Column) -> Column:
        check = (10 - luhn_sum(F.concat(new, F.lit("0"))) % 10) % 10
        return F.concat(new, check.cast("string"))

    return _laid_out(value, _let(feistel_digits(payload, key, F.lit("card"), inverse), checked), "[0-9]")


def _card_lengths(digits: Column) -> Column:
    """The lengths from 13 on of which the digits so far have a valid check digit, in one pass.

    Two Luhn sums run along: with every odd and with every even digit doubled.
    """
    start = F.struct(
        F.lit(0).alias("odd"), F.lit(0).alias("even"), F.lit(1).alias("at"), F.expr("cast(array() as array<int>)").alias("ok")
    )

    def step(s: Column, c: Column) -> Column:
        digit = c.cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        is_odd = s["at"] % 2 == 1
        odd = s["odd"] + F.when(is_odd, twice).otherwise(digit)
        even = s["even"] + F.when(is_odd, digit).otherwise(twice)
        # Of n digits the last one is not doubled.
        valid = (s["at"] >= 13) & (F.when(is_odd, even).otherwise(odd) % 10 == 0)
        return F.struct(
            odd.alias("odd"),
            even.alias("even"),
            (s["at"] + 1).alias("at"),
            F.when(valid, F.concat(s["ok"], F.array(s["at"]))).otherwise(s["ok"]).alias("ok"),
        )

    return F.aggregate(F.split(digits, ""), start, step, lambda s: s["ok"])


def _mod97(text: Column) -> Column:
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda s, c: F.when(c.rlike("^[0-9]$"), (s * 10 + c.try_cast("int")) % 97).otherwise(
            (s * 100 + F.ascii(c) - 55) % 97
        ),
    )


def _iban(value: Column, key: str, inverse: bool) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))

    def checked(new: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, check, new)

    new = feistel_text(account, key, F.concat(F.lit("iban"), country), inverse)
    return _laid_out(value, _let(new, checked), "[0-9A-Z]")


def _iban_valid(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    return _mod97(F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))) == 1


def _phone(value: Column, key: str, inverse: bool) -> Column:
    by_area = value.rlike(f"^{_BY_AREA}$")
    return _laid_out(
        value,
        _let(
            _digits(value),
            lambda d: F.when(by_area, _area_phone(d, key, inverse)).otherwise(
                F.concat(
                    F.substr(d, F.lit(1), F.lit(2)),
                    feistel_digits(F.substr(d, F.lit(3), F.length(d)), key, F.lit("phone"), inverse),
                )
            ),
        ),
        "[0-9]",
    )


def _area_phone(digits: Column, key: str, inverse: bool) -> Column:
    n = F.length(digits)

    def moved(last: Column) -> Column:
        area, exchange = _number(F.substr(last, F.lit(1), F.lit(3))), _number(F.substr(last, F.lit(4), F.lit(3)))
        code = feistel(
            ((area - 200) * 800 + exchange - 200) * 10000 + _number(F.substr(last, F.lit(7), F.lit(4))),
            F.expr("640000L"), F.expr("10000L"), key, F.lit("phone"), inverse,
        )
        local = _let(
            code,
            lambda c: F.concat(
                (F.floor(c / 10000 / 800) + 200).cast("string"),
                (F.floor(c / 10000) % 800 + 200).cast("string"),
                F.lpad((c % 10000).cast("string"), 4, "0"),
            ),
        )
        # Other numbers of that form keep the first digits of area and exchange, and with them their class.
        lead, mid = F.substr(last, F.lit(1), F.lit(1)), F.substr(last, F.lit(4), F.lit(1))
        free = F.concat(F.substr(last, F.lit(2), F.lit(2)), F.substr(last, F.lit(5), F.lit(6)))
        kept = _let(
            feistel_digits(free, key, F.concat(F.lit("phone class"), lead, mid), inverse),
            lambda m: F.concat(lead, F.substr(m, F.lit(1), F.lit(2)), mid, F.substr(m, F.lit(3), F.lit(6))),
        )
        return F.when((area >= 200) & (exchange >= 200), local).otherwise(kept)

    return F.concat(F.substr(digits, F.lit(1), n - 10), _let(F.substr(digits, n - 9, F.lit(10)), moved))


def _phone_valid(value: Column) -> Column:
    n = F.length(_digits(value))
    return value.rlike(f"^{_BY_AREA}$") | ((n >= 8) & (n <= 20))


def _ssn_parts(value: Column) -> list[Column]:
    return [_number(F.get(F.split(value, "-"), F.lit(i))) for i in range(3)]


def _ssn_valid(value: Column) -> Column:
    area, middle, last = _ssn_parts(value)
    return (area >= 1) & (area <= 899) & (area != 666) & (middle >= 1) & (last >= 1)


def _ssn(value: Column, key: str, inverse: bool) -> Column:
    area, middle, last = _ssn_parts(value)
    # 898 areas (666 is none), 99 middle and 9999 last numbers.
    code = ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + middle - 1) * 9999 + last - 1

    def written(new: Column) -> Column:
        rest = F.floor(new / 9999)
        place = F.floor(rest / 99) + 1
        return F.concat_ws(
            "-",
            F.lpad((place + F.when(place > 665, 1).otherwise(0)).cast("string"), 3, "0"),
            F.lpad((rest % 99 + 1).cast("string"), 2, "0"),
            F.lpad((new % 9999 + 1).cast("string"), 4, "0"),
        )

    return _let(feistel(code, F.expr("898L"), F.expr("989901L"), key, F.lit("ssn"), inverse), written)


def _ip(value: Column, key: str, inverse: bool) -> Column:
    octets = F.transform(F.split(value, r"\."), _number)
    code = F.aggregate(octets, F.expr("0L"), lambda s, x: s * 256 + x)
    new = feistel(code, F.expr("65536L"), F.expr("65536L"), key, F.lit("ip"), inverse)
    return _let(
        new,
        lambda n: F.concat_ws(
            ".", *[F.shiftright(n, 24 - 8 * i).bitwiseAND(F.lit(255)).cast("string") for i in range(4)]
        ),
    )


def _ip_valid(value: Column) -> Column:
    return F.forall(F.transform(F.split(value, r"\."), _number), lambda x: x <= 255)


def _as_date(year: Column, month: Column, day: Column) -> Column:
    """Null if there is no such day."""
    found = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
    return F.when(F.year(found) > 0, found)


def _day_of(value: Column) -> Column:
    """Year first with dashes, else year last and the month in the middle."""
    one, two, three = (F.get(F.split(value, r"[./\-]"), F.lit(i)) for i in range(3))
    return F.when(value.contains("-"), _as_date(one, two, three)).otherwise(_as_date(three, two, one))


def _date_valid(value: Column) -> Column:
    fields = F.split(value, "/")
    month, day, year = (F.get(fields, F.lit(i)) for i in range(3))
    # Month first only where the day can't be a month; February 29 is no day of every year.
    late = _as_date(year, month, day).isNotNull() & (_number(day) > 12) & ~((_number(month) == 2) & (_number(day) == 29))
    return F.when(_day_of(value).isNotNull(), F.lit(True)).otherwise(value.contains("/") & late)


def _date(value: Column, key: str, inverse: bool) -> Column:
    iso = value.contains("-")
    mark = F.when(value.contains("."), F.lit(".")).otherwise(F.lit("/"))

    def moved(day: Column) -> Column:
        # 400 years have 146097 = 189 * 773 days; the last cycle ends with 9999, after 145731 = 93 * 1567.
        cycle = F.floor(day / 146097)
        last = cycle == 24
        new = feistel(
            day - cycle * 146097,
            F.when(last, F.expr("93L")).otherwise(F.expr("189L")),
            F.when(last, F.expr("1567L")).otherwise(F.expr("773L")),
            key, F.concat(F.lit("date"), cycle.cast("string")), inverse,
        )
        return F.date_add(F.lit("0001-01-01").cast("date"), (cycle * 146097 + new).cast("int")).cast("string")

    def written(text: Column) -> Column:
        back = F.concat(F.substring(text, 9, 2), mark, F.substring(text, 6, 2), mark, F.substring(text, 1, 4))
        return F.when(iso, text).otherwise(back)

    def of_day(found: Column) -> Column:
        day = F.datediff(found, F.lit("0001-01-01").cast("date")).cast("long")
        return F.when(found.isNotNull(), _let(_let(day, moved), written)).otherwise(
            _month_first(F.split(value, "/"), key, inverse)
        )

    return _let(_day_of(value), of_day)


def _month_first(fields: Column, key: str, inverse: bool) -> Column:
    """month/day/year whose day can't be a month; stays in that class, so that it can be undone."""
    month, day, year = (_number(F.get(fields, F.lit(i))) for i in range(3))
    # 12 months of the days 13 to 28, and 9999 = 99 * 101 years.
    code = ((month - 1) * 16 + day - 13) * 9999 + year - 1
    new = feistel(code, F.expr("192L"), F.expr("9999L"), key, F.lit("month first"), inverse)
    late = feistel(year - 1, F.expr("99L"), F.expr("101L"), key, F.lit("late day"), inverse)

    def written(m: Column, d: Column, y: Column) -> Column:
        return F.concat_ws(
            "/", F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"), F.lpad(y.cast("string"), 4, "0")
        )

    early = _let(new, lambda n: written(F.floor(n / 9999 / 16) + 1, F.floor(n / 9999) % 16 + 13, n % 9999 + 1))
    return F.when(day <= 28, early).otherwise(written(month, day, late + 1))


def _email(value: Column, key: str, inverse: bool) -> Column:
    name = F.substring_index(value, "@", 1)
    return F.concat(feistel_text(name, key, F.lit("email"), inverse), F.lit("@"), F.substring_index(value, "@", -1))


_WORK = {
    "email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card,
}
#: What of a form is a value; cards are told by ``_card_lengths``, e-mail addresses by their form.
_VALID = {"iban": _iban_valid, "date": _date_valid, "ip": _ip_valid, "ssn": _ssn_valid, "phone": _phone_valid}
_NONE = "cast(array() as array<struct<rank: int, kind: string, value: string>>)"


def candidates(near: Column) -> Column:
    """(rank, kind, value) of each valid value that starts at the second character of ``near``, longest first.

    The first character is the one before. A look at what can start there comes first, then
    check digits, then how far a value reaches: most places of a table of numbers cost a few
    tests. Nothing is permuted here. A form is surer than a check digit, which one
    number in ten has by chance, or than an open end: a card ends before a date, ip, ssn or
    phone of fixed length starts, an open-ended phone before the first three, and none is
    looked for where a phone of fixed length starts.
    """

    def cut(kind: str, pattern: str) -> Column:
        value = F.regexp_extract(near, f"^(?s:.)({pattern})", 1)
        rank = -F.length(value) * len(KINDS) + KINDS.index(kind)
        return F.struct(rank.alias("rank"), F.lit(kind).alias("kind"), value.alias("value"))

    def where(starts: str, found: Column) -> Column:
        return F.when(near.rlike(f"^(?s:.){starts}"), found).otherwise(F.expr(_NONE))

    def values(*found: Column) -> Column:
        """Those that were found and are values."""

        def is_value(c: Column) -> Column:
            test = F.when(F.lit(False), F.lit(False))
            for kind, of_kind in _VALID.items():
                test = test.when(c["kind"] == kind, of_kind(c["value"]))
            return (c["value"] != "") & test

        return F.filter(F.array(*found), is_value)

    def before(forms: str, hint: str, found: Column) -> Column:
        """Of ``found`` those that end before any of ``forms`` starts; whatever has one has a ``hint``."""
        at = F.when(near.rlike(hint), F.regexp_instr(near, F.lit(forms))).otherwise(0)

        def ended(values: Column) -> Column:
            limited = _let(at, lambda x: F.filter(values, lambda c: (x == 0) | (F.length(c["value"]) + 1 < x)))
            return F.when(F.size(values) > 0, limited).otherwise(values)

        return _let(found, ended)

    def cards(lengths: Column) -> Column:
        cuts = [F.when(F.array_contains(lengths, n), cut("card", p)) for n, p in zip(range(13, 20), _CARDS)]
        return F.filter(F.array_compact(F.array(*cuts)), lambda c: c["value"] != "")

    run = r"[0-9](?:[ \-]?[0-9])"
    digits = F.translate(F.regexp_extract(near, rf"^(?s:.)({run}{{12,18}})", 1), " -", "")
    countries = F.filter(
        F.array(*[cut("phone", p) for p in _COUNTRY_PHONES]), lambda c: c["value"].rlike(f"^{_BY_COUNTRY}$")
    )
    every = F.concat(
        where(_PATTERNS["email"], F.array(cut("email", _PATTERNS["email"]))),
        where(
            f"(?:{_FORM}|{_AREA_PHONE})",
            values(*[cut(k, p) for k, p in _FORMS.items()], cut("phone", _AREA_PHONE)),
        ),
        where("(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}", values(*[cut("iban", p) for p in _IBANS])),
        where(
            rf"(?<![0-9A-Za-z]){run}{{12}}",
            before(f"{_FORM}|{_AREA_PHONE}", rf"{_MARKS}|{_BLANK_PHONE}", _let(_card_lengths(digits), cards)),
        ),
        where(rf"(?!{_AREA_PHONE})\+", before(_FORM, _MARKS, countries)),
    )
    return F.sort_array(every)


def pseudonym(value: Column, kind: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of a valid value."""
    out = F.when(F.lit(False), F.lit(""))
    for name in KINDS:
        out = out.when(kind == name, _WORK[name](value, key, inverse))
    return out


def _covered(spans: str) -> Column:
    """How much of each piece the values of earlier ones cover, from their lengths, left to right.

    A value that is covered itself covers nothing. The list is made in parts, of the square
    root of its length, because adding to a list copies it.
    """
    size = F.size(spans)
    part = F.greatest(F.lit(64), F.ceil(F.sqrt(size)).cast("int"))
    none = F.expr("cast(array() as array<int>)")

    def step(s: Column, x: Column) -> Column:
        ahead = F.when(s["left"] > 0, s["left"]).otherwise(x["value"])
        return F.struct(
            F.greatest(ahead - x["piece"], F.lit(0)).alias("left"),
            F.concat(s["covered"], F.array(F.least(s["left"], x["piece"]))).alias("covered"),
        )

    def of_part(s: Column, k: Column) -> Column:
        return F.aggregate(
            F.slice(spans, k * part + 1, part),
            F.struct(s["left"].alias("left"), none.alias("covered")),
            step,
            lambda t: F.struct(t["left"].alias("left"), F.concat(s["parts"], F.array(t["covered"])).alias("parts")),
        )

    start = F.struct(F.lit(0).alias("left"), F.expr("cast(array() as array<array<int>>)").alias("parts"))
    parts = F.sequence(F.lit(0), F.floor((size - 1) / part).cast("int"))
    return F.when(size > 0, F.aggregate(parts, start, of_part, lambda s: F.flatten(s["parts"]))).otherwise(none)


def pseudonymise(docs: DataFrame, key: str = DEMO_KEY, inverse: bool = False) -> DataFrame:
    """(doc_id, text, n_email, n_iban, n_date, n_ip, n_ssn, n_phone, n_card) for every row.

    Candidates of every kind and length are validated wherever one may start, and of the
    valid ones the leftmost, there the longest, is replaced; what fails hides nothing.
    The counts say how many of each kind were. With ``inverse`` and the same key,
    pseudonyms become the values again; dates of one or two digit fields come back with
    leading zeros, and February 29 written month first stays. Digits or capitals that
    stand beside a value so that both could be one longer value are told from it by the
    check digits alone, and those may pass for the pseudonym by chance (1 in 10 for cards,
    1 in 97 for IBANs); such a place does not come back. A null text stays null with
    counts 0. Repeated rows get a row each; an empty table gives an empty result; other
    columns are ignored.
    """
    text = F.col("text")
    # Texts without a digit or @ (most) skip the patterns.
    hint = text.rlike(_HINT)
    cut = docs.select(
        "doc_id",
        "text",
        F.when(hint, F.regexp_extract_all(text, F.lit(_START + _AHEAD), F.lit(1))).alias("ahead"),
        F.when(hint, F.split(text, _START, -1)).alias("pieces"),
    )
    # The text before the first start, if any, is a piece of its own.
    lead = F.size("pieces") - F.size("ahead")
    before = lambda i: F.coalesce(F.substring(F.get("pieces", i + F.col("lead") - 1), -1, 1), F.lit("\n"))
    tested = cut.select("*", lead.alias("lead")).select(
        "doc_id",
        "text",
        "pieces",
        "lead",
        F.transform("ahead", lambda x, i: F.get(candidates(F.concat(before(i), x)), F.lit(0))).alias("best"),
    )
    spans = tested.select(
        "*",
        F.transform(
            "best",
            lambda b, i: F.struct(
                F.length(F.get("pieces", i + F.col("lead"))).alias("piece"),
                F.coalesce(F.length(b["value"]), F.lit(0)).alias("value"),
            ),
        ).alias("spans"),
    )
    done = spans.select("doc_id", "text", "pieces", "lead", "best", _covered("spans").alias("covered"))
    taken = F.transform("best", lambda b, i: F.when(F.get("covered", i) == 0, b))

    def written(b: Column, i: Column) -> Column:
        piece = F.get("pieces", i + F.col("lead"))
        rest = F.substr(piece, F.get("covered", i) + F.coalesce(F.length(b["value"]), F.lit(0)) + 1)
        # Only what is replaced is permuted.
        new = F.when(b["value"].isNotNull(), pseudonym(b["value"], b["kind"], key, inverse))
        return F.concat(F.coalesce(new, F.lit("")), rest)

    done = done.select("doc_id", "text", "pieces", "lead", "covered", taken.alias("taken"))
    joined = F.concat(
        F.when(F.col("lead") > 0, F.get("pieces", F.lit(0))).otherwise(F.lit("")),
        F.array_join(F.transform("taken", written), ""),
    )
    count = lambda kind: F.coalesce(
        F.size(F.filter("taken", lambda b: b["kind"] == kind)).cast("long"), F.lit(0).cast("long")
    )
    return done.select(
        "doc_id",
        F.when(F.size("taken") > 0, joined).otherwise(text).alias("text"),
        *[F.greatest(F.lit(0).cast("long"), count(kind)).alias(f"n_{kind}") for kind in KINDS],
    )


