"""Format-preserving Feistel pseudonyms for personal data in texts (native).

A value is found by its pattern, checked (Luhn, mod 97, calendar, ranges) and
replaced by another value of the same format that passes the same check: a keyed
permutation of all values of that format. Equal values get equal pseudonyms in
every document, whatever their separators or letter case, so they stay linked,
and different values of a format never fall together.

The permutation is a Feistel network over a list of symbols, each of an alphabet
of its own size. Eight rounds add to the symbols at even or odd places, in turn,
numbers drawn from a keyed SHA-512 of the others, modulo each alphabet. A single
symbol has no others: it moves by a keyed number of places, never none. Check
digits are not permuted but computed anew.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for the key that a deployment keeps secret and passes in.
EXAMPLE_KEY = "corpus-pseudonyms-1"
ROUNDS = 8
#: Dates cover 400 years, a full cycle of the calendar. Those up to the 12th of a month
#: (144 a year) and the others (12 a year less than its days) are permuted apart: a day
#: whose number can be no month keeps such a number, and so a form that reads one way only.
_FIRST_DAY, _YEARS = "1800-01-01", 400
_EARLY_DAYS, _LATE_DAYS = (240, 240), (9, 9833)

_EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w@])"
_MARK = r"(?<=(?i:password=|token = \"))"
_BEFORE, _AFTER = r"(?<![\w@]|\d[.,-])", r"(?![\w@]|[.,-]\d)"
#: Countries by the length of their account numbers.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE BI", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CM CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "IR IS TR",
    27: "BF BJ CF CG DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BY CI CY DO GT HN HU LB ML MA NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """Letters and digits of the country's length; of any length for other countries."""
    known = {n: codes.replace(" ", "|") for n, codes in IBAN_COUNTRIES.items()}
    forms = [
        rf"(?:{codes})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f"(?: ?[A-Z0-9]{{{n % 4}}})" if n % 4 else "")
        for n, codes in known.items()
    ]
    other = rf"(?!{'|'.join(known.values())})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return rf"(?<!\w)(?:{'|'.join([*forms, other])})(?!\w)"


#: Pattern of each kind, tried in this order at each place.
PATTERNS = {
    "email": _EMAIL,
    "iban": _iban_pattern(),
    "date": _BEFORE
    + r"(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}|\d{2}-\d{2}-\d{4})"
    + rf"(?:(?=[Tt]\d{{2}}(?!\w*@))|{_AFTER})",
    "ssn": _BEFORE + r"\d{3}-\d{2}-\d{4}" + _AFTER,
    "ip": _BEFORE + r"\d{1,3}(?:\.\d{1,3}){3}" + _AFTER,
    "phone": r"(?<![\w@+])(?:(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[.-])[2-9]\d{2}[ .-]\d{4}"
    r"|\+[1-9]\d{0,2}(?:[ .-]?\(?\d{2,4}\)?){2,4})" + _AFTER,
    # In groups only as printed on cards; of more than four groups every run of four is tried.
    "card": _BEFORE
    + r"(?:\d{13,19}|\d{4}(?: \d{4}){3,}+|\d{4}(?:-\d{4}){3,}+|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})"
    + _AFTER,
    "secret": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)|" + _MARK + r"[0-9A-Fa-f]{16,}+(?!\w)",
}
#: At each place that may begin an account number, before any check; they may overlap.
_IBAN_LIKE = rf"(?<!\w)(?=({PATTERNS['iban']}))"
_IBAN_START = r"(?<!\w)[A-Z]{2}\d{2}[ A-Z0-9]"
_KEPT = "[^A-Za-z0-9]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: an array of one element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def permute(symbols: Column, sizes: Column, key: str, kind: str, tweak: Column | None = None) -> Column:
    """`symbols` (bigints, each below its size) under the keyed permutation of a kind and a tweak."""
    named = F.lit(kind) if tweak is None else F.concat(F.lit(f"{kind}|"), tweak)
    number = lambda digest, i: F.conv(F.substring(digest, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
    digest = lambda *told: F.sha2(F.concat_ws("|", F.lit(key), named, *told).cast("binary"), 512)

    def alone(state: Column) -> Column:
        step = number(digest(), F.lit(0))
        moved = lambda x, i: F.pmod(x + 1 + step % F.greatest(F.lit(1), F.get(sizes, i) - 1), F.get(sizes, i))
        return F.transform(state, moved)

    def one_round(state: Column, r: Column) -> Column:
        others = F.filter(state, lambda x, i: i % 2 != r % 2)
        told = digest(r.cast("string"), F.array_join(others.cast("array<string>"), ","))
        moved = lambda drawn, x, i: F.pmod(x + number(drawn, (i / 2).cast("int") % 16), F.get(sizes, i))
        return _let(told, lambda drawn: F.transform(state, lambda x, i: F.when(i % 2 == r % 2, moved(drawn, x, i)).otherwise(x)))

    def network(state: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state, one_round)

    return _let(symbols, lambda state: F.when(F.size(state) == 1, alone(state)).otherwise(network(state)))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _symbol(c: Column) -> Column:
    code = F.ascii(F.lower(c)).cast("bigint")
    return F.when(code >= 97, code - 97).otherwise(code - 48)


def _size(c: Column) -> Column:
    return F.when(F.ascii(c) >= 65, 26).otherwise(10).cast("bigint")


def _written(symbol: Column, like: Column) -> Column:
    """A symbol as a character of the class and case of another one."""
    base = F.when(F.ascii(like) >= 97, 97).when(F.ascii(like) >= 65, 65).otherwise(48)
    return F.char(symbol + base)


def _refill(text: Column, fresh: Column) -> Column:
    """The letters and digits of `text` replaced in turn by the elements of `fresh`; the rest stays."""
    place = lambda i: F.length(F.regexp_replace(F.substring(text, F.lit(1), i), _KEPT, ""))
    return F.array_join(
        F.transform(
            _characters(text), lambda c, i: F.when(c.rlike(_KEPT), c).otherwise(F.get(fresh, place(i)))
        ),
        "",
    )


def _letters(text: Column, key: str, kind: str, tweak: Column | None = None) -> Column:
    """All letters and digits of a text permuted, case and separators kept."""
    plain = _characters(F.regexp_replace(text, _KEPT, ""))
    changed = permute(F.transform(plain, _symbol), F.transform(plain, _size), key, kind, tweak)
    return _refill(text, F.zip_with(changed, plain, _written))


def _digits(text: Column) -> Column:
    return F.transform(_characters(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("bigint"))


def _as_strings(numbers: Column) -> Column:
    return numbers.cast("array<string>")


def _luhn(digits: Column) -> Column:
    """The sum that must be a multiple of ten; the last digit is the check digit."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(
        F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 1, doubled(d)).otherwise(d)),
        F.lit(0).cast("bigint"),
        lambda total, d: total + d,
    )


def _card(text: Column, key: str) -> Column:
    """Numbers of 13 to 19 digits with a right check digit, in one piece or in groups of 4 4 4 4 or 4 6 5.

    The first digit (the network) stays. Of a longer run of groups the leftmost four
    that are a card are replaced, then the next behind them; the others stay.
    """
    mark = F.when(text.contains("-"), "-").otherwise(" ")
    groups = F.split(text, "[ -]")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(0).alias("skip"))

    def step(state: Column, i: Column) -> Column:
        four = F.array_join(F.slice(groups, i, F.lit(4)), " ")
        fresh = F.when((state["skip"] == 0) & (i + 3 <= F.size(groups)), _one_card(four, key))
        none = F.array().cast("array<string>")

        def after(card: Column) -> Column:
            own = F.when(state["skip"] > 0, none).otherwise(F.array(F.coalesce(card, F.get(groups, i - 1))))
            skip = F.when(card.isNotNull(), 3).otherwise(F.greatest(F.lit(0), state["skip"] - 1))
            return F.struct(F.concat(state["done"], own).alias("done"), skip.alias("skip"))

        return _let(fresh, after)

    run = F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step, lambda state: F.array_join(state["done"], " "))
    return F.when(F.size(groups) > 4, F.replace(run, F.lit(" "), mark)).otherwise(_one_card(text, key))


def _one_card(text: Column, key: str) -> Column:
    digits = _digits(text)
    body = F.slice(digits, F.lit(2), F.size(digits) - 2)
    first = F.slice(digits, 1, 1)
    fresh = F.concat(first, permute(body, F.transform(body, lambda _: F.lit(10).cast("bigint")), key, "card"))
    check = F.pmod(-_luhn(F.concat(fresh, F.array(F.lit(0).cast("bigint")))), F.lit(10))
    known = F.get(digits, F.lit(0)).isin(2, 3, 4, 5, 6) & (_luhn(digits) % 10 == 0)
    return F.when(known, _refill(text, _as_strings(F.concat(fresh, F.array(check)))))


def _ip(text: Column, key: str) -> Column:
    """Four numbers up to 255, without leading zeros."""
    parts = F.transform(F.split(text, "[.]"), lambda part: part.cast("bigint"))
    right = F.forall(parts, lambda x: x < 256) & ~text.rlike(r"(^|\.)0\d")
    sizes = F.transform(parts, lambda _: F.lit(256).cast("bigint"))
    return F.when(right, F.array_join(_as_strings(permute(parts, sizes, key, "ip")), "."))


def _phone(text: Column, key: str) -> Column:
    """North American numbers keep their form; others of 8 to 15 digits keep the country code's digits.

    The prefix that stays is `+1`, or else the group after `+`.
    """
    lead = F.regexp_extract(text, r"^\+?1[ .-]?(?=[(2-9])|^\+\d{1,3}", 0)
    rest = F.substring(text, F.length(lead) + 1, F.length(text))
    digits = _digits(rest)
    american = text.rlike(r"^(\+?1[ .-]?)?(\([2-9]\d{2}\) ?|[2-9]\d{2}[.-])[2-9]\d{2}[ .-]\d{4}$")
    limited = lambda i: american & i.isin(0, 3)  # noqa: E731  an area or exchange starts with 2 to 9
    symbols = F.transform(digits, lambda d, i: F.when(limited(i), d - 2).otherwise(d))
    sizes = F.transform(digits, lambda _, i: F.when(limited(i), 8).otherwise(10).cast("bigint"))
    fresh = permute(symbols, sizes, key, "phone")
    fresh = F.transform(fresh, lambda d, i: F.when(limited(i), d + 2).otherwise(d))
    total = F.size(_digits(text))
    return F.when(american | total.between(8, 15), F.concat(lead, _refill(rest, _as_strings(fresh))))


def _ssn(text: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups and serials that are not zero."""
    parts = F.transform(F.split(text, "-"), lambda part: part.cast("bigint"))
    area, group, serial = (F.get(parts, F.lit(i)) for i in range(3))
    right = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    sizes = F.array(*[F.lit(n).cast("bigint") for n in (898 * 99, 9999)])
    fresh = permute(F.array(index * 99 + group - 1, serial - 1), sizes, key, "ssn")
    place = F.floor(F.get(fresh, F.lit(0)) / 99)
    place = F.when(place >= 665, place + 2).otherwise(place + 1)
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    return F.when(
        right,
        F.concat_ws("-", pad(place, 3), pad(F.get(fresh, F.lit(0)) % 99 + 1, 2), pad(F.get(fresh, F.lit(1)) + 1, 4)),
    )


def _date(text: Column, key: str) -> Column:
    """Days from 1800 to 2199, in the form in which they are written.

    With slashes or hyphens and the year last, the month comes first where that
    gives a date, else the day.
    """
    forms = (
        (r"^\d{4}-", "yyyy-MM-dd"),
        (r"^\d{4}/", "yyyy/MM/dd"),
        (r"^\d{2}\.", "dd.MM.yyyy"),
        (r"^\d{2}/", "MM/dd/yyyy"),
        (r"^\d{2}/", "dd/MM/yyyy"),
        (r"^\d{2}-", "MM-dd-yyyy"),
        (r"^\d{2}-", "dd-MM-yyyy"),
    )
    tries = []
    for start, form in forms:
        # Parsed by its parts: the calendar decides, not a parser's policy.
        cut = {c: F.substring(text, form.index(c) + 1, form.count(c)) for c in "yMd"}
        date = F.try_to_date(F.concat_ws("-", cut["y"], cut["M"], cut["d"]), "yyyy-MM-dd")
        in_range = cut["y"].between(_FIRST_DAY[:4], str(int(_FIRST_DAY[:4]) + _YEARS - 1))
        read = F.struct(date.alias("date"), F.lit(form).alias("form"))
        tries.append(F.when(text.rlike(start) & in_range & date.isNotNull(), read))
    return _let(F.coalesce(*tries), lambda read: F.call_function("date_format", _moved(read["date"], key), read["form"]))


def _days_since(date: Column) -> Column:
    return F.datediff(date, F.lit(_FIRST_DAY).cast("date")).cast("bigint")


def _month_start(months: Column) -> Column:
    """The first day of a month, counted from the first one."""
    return F.add_months(F.lit(_FIRST_DAY).cast("date"), months.cast("int"))


def _moved(date: Column, key: str) -> Column:
    """The date under the permutation of its half of the days."""

    def through(index: Column, sizes: tuple[int, int], kind: str) -> Column:
        limits = F.array(*[F.lit(n).cast("bigint") for n in sizes])
        fresh = permute(F.array(F.floor(index / sizes[1]), index % sizes[1]), limits, key, kind)
        return _let(fresh, lambda x: F.get(x, F.lit(0)) * sizes[1] + F.get(x, F.lit(1)))

    def early_date(index: Column) -> Column:
        return F.date_add(_month_start(F.floor(index / 12)), (index % 12).cast("int"))

    def late_date(index: Column) -> Column:
        # The month that holds a late day is the one at its even share, or next to it.
        guess = F.floor(index * (12 * _YEARS) / (_LATE_DAYS[0] * _LATE_DAYS[1]))
        near = _let(guess, lambda g: F.array(g - 1, g, g + 1))
        near = F.filter(near, lambda m: m.between(0, 12 * _YEARS - 1) & (before(m) <= index))
        return _let(F.array_max(near), lambda m: F.date_add(_month_start(m), (12 + index - before(m)).cast("int")))

    before = lambda m: _days_since(_month_start(m)) - 12 * m
    month = ((F.year(date) - int(_FIRST_DAY[:4])) * 12 + F.month(date) - 1).cast("bigint")
    early = through(month * 12 + F.day(date) - 1, _EARLY_DAYS, "early date")
    late = through(_days_since(date) - 12 * (month + 1), _LATE_DAYS, "late date")
    return F.when(F.day(date) <= 12, _let(early, early_date)).otherwise(_let(late, late_date))


def _mod97(text: Column) -> Column:
    """The remainder by 97 of letters and digits, letters counting from 10."""
    value = lambda c: F.conv(c, 36, 10).cast("bigint")
    return F.aggregate(
        _characters(text),
        F.lit(0).cast("bigint"),
        lambda rest, c: (rest * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97,
    )


def _is_iban(text: Column) -> Column:
    """Whether the check digits of a match are right."""
    plain = F.regexp_replace(text, " ", "")
    return (F.length(plain) >= 15) & (_mod97(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))) == 1)


def _iban(text: Column, key: str) -> Column:
    """Account numbers with right check digits; the country and the places of letters stay."""
    plain = F.regexp_replace(text, " ", "")
    country, body = F.substring(plain, 1, 2), F.substring(plain, 5, 64)
    fresh = _letters(body, key, "iban")
    check = F.lpad((98 - _mod97(F.concat(fresh, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(_is_iban(text), _refill(text, _characters(F.concat(country, check, fresh))))


def _email(text: Column, key: str) -> Column:
    """The part before `@`; the domain stays, and short names are permuted for each domain apart."""
    local = F.substring_index(text, "@", 1)
    domain = F.substring(text, F.length(local) + 1, F.length(text))
    tweak = F.when(F.length(F.regexp_replace(local, _KEPT, "")) <= 2, F.lower(domain)).otherwise("")
    return F.concat(_letters(local, key, "email", tweak), domain)


def _secret(text: Column, key: str) -> Column:
    """Access keys after their mark, and hexadecimal passwords and tokens, digit by digit.

    The case of each letter stays; a letter in a digit's place has that of the first letter.
    """
    hexadecimal = text.rlike("^[0-9A-Fa-f]+$")
    nibbles = F.transform(_characters(text), lambda c: F.conv(c, 16, 10).cast("bigint"))
    sizes = F.transform(nibbles, lambda _: F.lit(16).cast("bigint"))
    upper = lambda c: c.rlike("[A-F]") | (c.rlike("[0-9]") & text.rlike("^[0-9]*[A-F]"))
    fresh = F.zip_with(
        permute(nibbles, sizes, key, "secret"),
        _characters(text),
        lambda x, c: F.when(upper(c), F.hex(x)).otherwise(F.lower(F.hex(x))),
    )
    marked = F.concat(F.lit("AKIA"), _letters(F.substring(text, 5, 64), key, "secret"))
    return F.when(hexadecimal, F.array_join(fresh, "")).otherwise(marked)


KINDS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "iban": _iban, "date": _date, "ssn": _ssn,
    "ip": _ip, "phone": _phone, "card": _card, "secret": _secret,
}


def _kind(found: Column) -> Column:
    """The first kind whose pattern a match has, taken by itself."""
    fits = {kind: found.rlike(f"^(?:{_alone(p)})$") for kind, p in PATTERNS.items()}
    fits["iban"] = fits["iban"] & _is_iban(found)
    return F.coalesce(*[F.when(fit, kind) for kind, fit in fits.items()])


def _alone(pattern: str) -> str:
    """A pattern for a match without its surroundings."""
    return pattern.replace(_MARK, "")


def _any(ibans: Column) -> Column:
    """The pattern of all kinds for a text that holds these account numbers.

    They stand in it letter by letter, so that what only looks like one draws in
    nothing, neither a true one nor a value of another kind.
    """
    true = F.when(F.size(ibans) > 0, F.concat(F.lit(r"(?<!\w)(?:"), F.array_join(ibans, "|"), F.lit(r")(?!\w)")))
    parts = [
        F.coalesce(true, F.lit("(?!)")) if kind == "iban" else F.lit(f"(?:{pattern})")
        for kind, pattern in PATTERNS.items()
    ]
    return F.concat_ws("|", *parts)


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one matched value; the value itself where its check fails."""
    kind = _kind(found)
    made = reduce(
        lambda chosen, name: chosen.when(kind == name, KINDS[name](found, key)),
        list(KINDS)[1:],
        F.when(kind == next(iter(KINDS)), next(iter(KINDS.values()))(found, key)),
    )
    return F.coalesce(made, found)


def pseudonymise(table: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`table` with personal data in `text` replaced, and `n_replaced`, the count of changed values.

    A column of that name (in any case) is replaced; others may have any name. A
    null text stays null, with a count of 0; an empty text stays empty, an empty
    table gives an empty result. Values whose check fails stay as they are, and all
    else in a text is unchanged to the byte. Texts are read whole, whatever their
    length, and held by one task with a few times their size. Repeated rows are
    treated alike.
    """
    source = F.col(f"`{text}`").cast("string")
    own = "__"
    while any(c.lower().startswith(own) for c in table.columns):
        own += "_"
    ibans, pattern, found, fresh = (own + name for name in ("ibans", "any", "found", "fresh"))
    # Most texts hold nothing; a cheap test spares them the patterns.
    likely = F.when(source.rlike(_IBAN_START), F.regexp_extract_all(source, F.lit(_IBAN_LIKE), F.lit(1)))
    rows = table.withColumn(ibans, F.array_distinct(F.filter(likely, _is_iban)))
    rows = rows.withColumn(pattern, _any(F.col(ibans)))
    matches = F.when(source.rlike("[0-9@]") | source.rlike("(?i:password=|token = )"), F.regexp_extract_all(source, F.col(pattern), F.lit(0)))
    rows = rows.withColumn(found, matches)
    rows = rows.withColumn(fresh, F.transform(found, lambda value: pseudonym(value, key)))
    woven = F.zip_with(
        F.split(source, F.col(pattern), -1), fresh, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))
    )
    changed = F.filter(F.zip_with(found, fresh, lambda a, b: a != b), lambda differs: differs)
    held = F.size(found) > 0
    columns = [
        F.when(held, F.array_join(woven, "")).otherwise(source).alias(c) if c == text else F.col(f"`{c}`")
        for c in table.columns
        if c.lower() != "n_replaced"
    ]
    return rows.select(*columns, F.when(held, F.size(changed)).otherwise(0).alias("n_replaced"))
