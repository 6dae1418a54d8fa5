"""Format-preserving pseudonyms for personal numbers, dates and addresses in texts.

Found values are validated (check digit, value ranges, calendar) and replaced within their format:
a number is split in two parts that a keyed Feistel network of ``ROUNDS`` rounds adds to in turn,
modulo the parts' sizes, which permutes the format's whole domain. Equal values therefore get equal
pseudonyms in all documents and different values of one format different ones. Separators, country
codes, the first digit of a card and the order of a date stay; the check digit is computed anew.
Mail addresses have no fixed domain: their local part is rewritten letter by letter from a keyed
digest and the host becomes ``HOST``.

Everything is made of Spark functions: one scan cuts the text at the matches, one lists them.

Defined results: a null text stays null; a text without digits and ``@`` is returned untouched;
matches that fail validation stay; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
HOST = "pseudonym.invalid"
FIRST_DAY, DAY_PARTS = "1900-01-01", (319, 229)  # 319 * 229 days: the years 1900 to 2099

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# A host is labels with dots and a top level of letters. Possessive groups, which Java's matcher repeats in
# a loop instead of by recursion, take a label only if two letters follow somewhere after its dot, as
# a top level needs them; labels that do not begin with two letters are skipped together.
_LABEL = r"[A-Za-z0-9-]++\."
_NO_TOP = rf"(?:(?![A-Za-z]{{2}}){_LABEL})*+"
_LOCAL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++"
MAIL = rf"{_LOCAL}@{_LABEL}{_NO_TOP}(?:{_LABEL}{_NO_TOP}(?=[A-Za-z]{{2}}))*+[A-Za-z]{{2,}}+"
CARD = (
    r"(?<!\d)(?<!\d[.,])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?!\d)"
)
PHONE = (
    r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ -]?\(?\d{2,4}\)?){2,5}(?!\d|\.\d)"
    r"|(?<![\w+])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\w.+-])\d{3}([.-])\d{3}\3\d{4}(?![\d.-]\d|\d)"
)
ADDRESS = rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)"
SOCIAL = r"(?<![\d-])(?!000|666|9\d\d)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?!\d|-\d)"
_YEAR, _MONTH, _DAY = r"(?:19|20)\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
DATE = (
    rf"(?<![\d-]){_YEAR}-{_MONTH}-{_DAY}(?!\d|-\d)"
    rf"|(?<![\d.]){_DAY}\.{_MONTH}\.{_YEAR}(?!\d|\.\d)"
    rf"|(?<![\d/]){_DAY}/{_DAY}/{_YEAR}(?!\d|/\d)"
)
FOUND = "|".join(f"(?:{p})" for p in (MAIL, CARD, PHONE, SOCIAL, ADDRESS, DATE))


def _draw(key: str, kind: str, n: Column, value: Column) -> Column:
    """A keyed number below 2**60 for a round and a part of the value."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """Struct (l, r) of the permuted parts, l below ``a`` and r below ``b`` (both below 2**60)."""

    def turn(state: Column, n: Column) -> Column:
        even = n % 2 == 0
        moved_l = F.pmod(state["l"] + F.pmod(_draw(key, kind, n, state["r"]), a), a)
        moved_r = F.pmod(state["r"] + F.pmod(_draw(key, kind, n, state["l"]), b), b)
        return F.struct(
            F.when(even, moved_l).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(moved_r).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of 2 to 18 digits permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    parts = _feistel(
        key,
        kind,
        F.substring(digits, F.lit(1), half),
        F.substring(digits, half + 1, n - half),
        _power(half),
        _power(n - half),
    )
    return _let(
        parts,
        lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), n - half, "0")),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _in_format(value: Column, digits: Column) -> Column:
    """The value with its digits exchanged for the given ones, in order."""
    chars = F.split(value, "")
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(
                c.rlike("[0-9]"),
                F.substring(digits, F.length(_digits(F.substring(value, F.lit(1), i + 1))), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def _luhn_sum(digits: Column, doubled_parity: int) -> Column:
    """Sum where every second digit counted from the right is doubled; parity 1 for whole numbers."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == doubled_parity, twice).otherwise(d)

    turned = F.split(F.reverse(digits), "")
    return F.aggregate(F.transform(turned, worth), F.lit(0), lambda s, x: s + x)


def _card(key: str, value: Column) -> Column:
    def new(d: Column) -> Column:
        payload = F.concat(
            F.substring(d, 1, 1), _permute_digits(key, "card", F.substring(d, F.lit(2), F.length(d) - 2))
        )
        whole = _let(
            payload, lambda p: F.concat(p, F.pmod(10 - F.pmod(_luhn_sum(p, 0), F.lit(10)), F.lit(10)).cast("string"))
        )
        valid = F.pmod(_luhn_sum(d, 1), F.lit(10)) == 0
        return F.when(valid, _let(whole, lambda w: _in_format(value, w))).otherwise(value)

    return _let(_digits(value), new)


def _phone(key: str, value: Column) -> Column:
    country = F.regexp_extract(value, r"^\+(1|\d{1,3}(?=[ (.-])|\d)", 1)

    def new(d: Column) -> Column:
        rest = F.substring(d, F.length(country) + 1, F.length(d) - F.length(country))
        permuted = F.concat(country, _permute_digits(key, "phone", rest))
        return F.when(F.length(d).between(8, 15), _let(permuted, lambda p: _in_format(value, p))).otherwise(value)

    return _let(_digits(value), new)


def _social(key: str, value: Column) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group = F.substring(value, 1, 3).cast("int"), F.substring(value, 5, 2).cast("int")
    left = area - 1 - F.when(area > 666, 1).otherwise(0)
    right = (group - 1) * 9999 + F.substring(value, 8, 4).cast("int") - 1

    def written(p: Column) -> Column:
        new_area = p["l"] + 1 + F.when(p["l"] >= 665, 1).otherwise(0)
        parts = [(new_area, 3), (F.floor(p["r"] / 9999) + 1, 2), (p["r"] % 9999 + 1, 4)]
        return F.concat_ws("-", *(F.lpad(x.cast("long").cast("string"), n, "0") for x, n in parts))

    return _let(_feistel(key, "social", left, right, F.lit(898), F.lit(99 * 9999)), written)


def _address(key: str, value: Column) -> Column:
    def new(o: Column) -> Column:
        left = F.get(o, F.lit(0)).cast("int") * 256 + F.get(o, F.lit(1)).cast("int")
        right = F.get(o, F.lit(2)).cast("int") * 256 + F.get(o, F.lit(3)).cast("int")
        size = F.lit(1 << 16)

        def written(p: Column) -> Column:
            octets = [F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256]
            return F.concat_ws(".", *(x.cast("long").cast("string") for x in octets))

        return _let(_feistel(key, "address", left, right, size, size), written)

    return _let(F.split(value, r"\."), new)


def _date(key: str, value: Column) -> Column:
    """ISO, day.month.year, and month/day/year (day/month/year where the former is no date)."""
    a, b = DAY_PARTS

    def as_(form: str) -> Column:
        day = F.try_to_timestamp(value, F.lit(form)).cast("date")
        place = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        moved = _feistel(key, "date", F.floor(place / b), F.pmod(place, F.lit(b)), F.lit(a), F.lit(b))
        new = _let(
            moved, lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * b + p["r"]).cast("int")), form)
        )
        return F.when(day.isNotNull(), new)

    forms = {"-": ["yyyy-MM-dd"], ".": ["dd.MM.yyyy"], "/": ["MM/dd/yyyy", "dd/MM/yyyy"]}
    tried = [F.when(value.contains(mark), as_(form)) for mark, some in forms.items() for form in some]
    return F.coalesce(*tried, value)


def _mail(key: str, value: Column) -> Column:
    letters = F.split(F.regexp_extract(value, "^([^@]+)@", 1), "")

    def rewritten(whole: Column) -> Column:
        def letter(c: Column, i: Column) -> Column:
            drawn = _draw(key, "mail", i, whole)
            alphabet = F.when(c.rlike("[0-9]"), F.lit("0123456789")).otherwise(F.lit("abcdefghijklmnopqrstuvwxyz"))
            new = F.substring(alphabet, F.pmod(drawn, F.length(alphabet)).cast("int") + 1, F.lit(1))
            return F.when(c.rlike("[0-9A-Za-z]"), new).otherwise(c)

        return F.concat(F.array_join(F.transform(letters, letter), ""), F.lit(f"@{HOST}"))

    return _let(F.sha2(F.lower(value), 256), rewritten)  # a long address is hashed once


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value."""

    def is_(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    kinds = [(DATE, _date), (SOCIAL, _social), (ADDRESS, _address), (CARD, _card)]
    out = F.when(is_(MAIL), _mail(key, value)).when(value.startswith("+"), _phone(key, value))
    for pattern, make in kinds:
        out = out.when(is_(pattern), make(key, value))
    return out.otherwise(_phone(key, value))


def found_values(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(FOUND), F.lit(0))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """Replaces the values in ``text``; ``count`` names a column for the number of values found. The
    other columns stay, whatever their names."""
    own = F.col("row").getField(text)
    df = docs.select(F.struct("*").alias("row"))
    df = df.withColumn("found", F.when(own.rlike("[0-9@]"), found_values(own)))
    df = df.withColumn("new", F.transform("found", lambda v: pseudonym(v, key)))
    pieces = F.zip_with(F.split(own, FOUND, -1), F.col("new"), lambda p, v: F.array(p, F.coalesce(v, F.lit(""))))
    rebuilt = F.when(F.size("found") > 0, F.array_join(F.flatten(pieces), "")).otherwise(own)
    kept = [(rebuilt if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns if c != count]
    if count:
        kept.append(F.coalesce(F.size("found"), F.lit(0)).cast("long").alias(count))
    return df.select(*kept)
