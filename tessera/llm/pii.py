"""PII (9): format-preserving Feistel pseudonyms, in DataFrame functions only.

Card numbers (Luhn), phone numbers, IPv4 addresses, US social security numbers and
dates are validated and permuted within their format by a keyed Feistel network, so a
value has the same pseudonym in every document and two values never share one. An
e-mail address becomes a keyed digest at a reserved domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.decontam import bind

ROUNDS = 10
#: 400 Gregorian years from here are 146,097 = 189 * 773 days.
FIRST_DAY, DAY_A, DAY_B = "1700-01-01", 189, 773

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
PHONE = (r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
         r"|(?:\+[0-9]{1,3}[ .-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])")
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])"
DAY_DATE = r"(?<![0-9/.])(?:[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[/.][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
ANY = "|".join([EMAIL, PHONE, IPV4, ISO_DATE, DAY_DATE, SSN, CARD])


def _number(key: str, kind: str, step: Column, half: Column, modulus: Column) -> Column:
    """Round function: 48 bits of a keyed digest, reduced."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), modulus.cast("string"), half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), modulus)


def feistel(value: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Keyed permutation of 0 .. a*b-1: each round adds a digest of one half to the
    other, so every round can be undone and no two values meet."""
    a, b, v = a.cast("long"), b.cast("long"), value.cast("long")
    first = F.struct(((v - F.pmod(v, b)) / b).cast("long").alias("x"), F.pmod(v, b).alias("y"))

    def turn(s: Column, i: Column) -> Column:
        even = F.struct(F.pmod(s["x"] + _number(key, kind, i, s["y"], a), a).alias("x"), s["y"].alias("y"))
        odd = F.struct(s["x"].alias("x"), F.pmod(s["y"] + _number(key, kind, i, s["x"], b), b).alias("y"))
        return F.when(F.pmod(i, F.lit(2)) == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turn, lambda s: s["x"] * b + s["y"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits from the right, those at places ``doubled`` modulo 2 doubled."""
    places = F.sequence(F.lit(0), F.char_length(digits) - 1)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(F.pmod(i, F.lit(2)) == doubled, twice).otherwise(d)

    return F.aggregate(places, F.lit(0), add)


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Digits (up to 18) permuted among all strings of as many digits."""
    n = F.char_length(digits)
    left, right = F.floor(n / 2), n - F.floor(n / 2)
    power = lambda k: F.concat(F.lit("1"), F.repeat(F.lit("0"), k.cast("int"))).cast("long")
    return F.lpad(feistel(digits.cast("long"), power(left), power(right), key, kind).cast("string"), n, F.lit("0"))


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    def at(i: Column) -> Column:
        c = F.substring(shape, i, F.lit(1))
        nth = F.char_length(_digits(F.substring(shape, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(shape)), at), "")


def _date(found: Column, fmt: str, key: str) -> Column:
    """Another day of the same 400 years, in the same format; null if it is no date."""
    day = F.try_to_timestamp(found, F.lit(fmt)).cast("date")
    n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    inside = n.between(0, DAY_A * DAY_B - 1)
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), feistel(n, F.lit(DAY_A), F.lit(DAY_B), key, "date").cast("int"))
    return F.when(inside, F.date_format(moved, fmt))


def pseudonym(found: Column, key: str) -> Column:
    """``(kind, value)`` of one match of ``ANY``; null if it does not validate."""
    kind = lambda name, value: F.when(value.isNotNull(), F.struct(F.lit(name).alias("kind"), value.alias("value")))
    whole = lambda pattern: found.rlike(f"^(?:{pattern})$")
    octets = F.split(found, r"\.")
    octet = lambda i: F.get(octets, F.lit(i)).cast("long")
    valid_ip = F.forall(octets, lambda o: o.cast("int") <= 255)
    ip = bind(feistel(octet(0) * 16777216 + octet(1) * 65536 + octet(2) * 256 + octet(3), F.lit(65536), F.lit(65536), key, "ipv4"),
              lambda v: F.concat_ws(".", *[F.pmod(F.shiftright(v, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))
    digits = _digits(found)
    national = F.right(digits, F.lit(10))
    phone = _refilled(found, F.concat(F.substring(digits, F.lit(1), F.char_length(digits) - 10), _permuted_digits(national, key, "phone")))
    area, group, serial = (F.substring(found, *p) for p in ((1, 3), (5, 2), (8, 4)))
    valid_ssn = ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")
    ssn = _refilled(found, _permuted_digits(digits, key, "ssn"))
    payload = F.substring(digits, F.lit(1), F.char_length(digits) - 1)
    card = bind(_permuted_digits(payload, key, "card"), lambda p: _refilled(found, F.concat(
        p, F.pmod(F.lit(10) - F.pmod(_luhn_sum(p, 0), F.lit(10)), F.lit(10)).cast("string"))))
    valid_card = F.pmod(_luhn_sum(digits, 1), F.lit(10)) == 0
    mail = F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(found)), 256), 1, 16),
                    F.lit("@mail.invalid"))
    return (F.when(found.contains("@"), kind("email", mail))
            .when(whole(IPV4), F.when(valid_ip, kind("ipv4", ip)))
            .when(whole(ISO_DATE), kind("date", _date(found, "yyyy-MM-dd", key)))
            .when(whole(DAY_DATE), F.coalesce(*[
                kind("date", _date(found, f"{order[0]}{sep}{order[1]}{sep}yyyy", key))
                for sep in "/." for order in (("dd", "MM"), ("MM", "dd"))]))
            .when(whole(SSN), F.when(valid_ssn, kind("ssn", ssn)))
            .when(whole(CARD), F.when(valid_card, kind("card", card)))
            .otherwise(kind("phone", phone)))


def pseudonymise(df: DataFrame, key: str, text_col: str = "text", found_col: str = "pii") -> DataFrame:
    """``df`` with the personal data in ``text_col`` replaced and a column ``found_col``
    (overwritten if it exists) that lists ``(kind, value)``, the kind and the pseudonym
    of every replaced match, in order. Matches that do not validate (a card number whose
    check digit is wrong, an octet over 255, a day that does not exist or lies outside
    1700-2099) stay. A null text stays null with an empty list; rows are independent, so
    empty tables, repeated rows and long texts need no care."""
    text = F.col(f"`{text_col}`")
    none = F.expr("cast(array() as array<struct<found:string,p:struct<kind:string,value:string>>>)")
    matches = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
                          lambda m: F.struct(m.alias("found"), pseudonym(m, key).alias("p")))
    named = "__matches"
    out = df.withColumn(named, F.when(text.rlike(ANY), matches).otherwise(none))
    gaps = F.split(text, ANY, -1)
    filled = F.array_join(F.zip_with(gaps, F.col(named), lambda gap, m: F.concat(
        F.coalesce(gap, F.lit("")), F.coalesce(m["p"]["value"], m["found"], F.lit("")))), "")
    valid = F.filter(F.transform(named, lambda m: m["p"]), lambda p: p.isNotNull())
    return out.withColumn(text_col, F.when(F.size(named) > 0, filled).otherwise(text)).withColumn(found_col, valid).drop(named)
